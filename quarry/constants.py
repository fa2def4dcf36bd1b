"""Fixed values that must equal the reference's for identical results.

These are stated plainly and together; everything else in the package is our own."""

# --- fixed values: runtime constants -------------------------------------------------
MAX_SEQ_LEN = 2048                 # context length T
TIME_BUDGET = 300                  # training budget, seconds
EVAL_TOKENS = 40 * 524288          # tokens scored by the validation metric
VOCAB_SIZE = 8192                  # including the special tokens
VAL_SHARD = 6542                   # pinned validation shard id
VAL_FRACTION = 0.10                # share of documents held out
MIN_VAL_DOCS = 50                  # at least this many validation documents
DOCS_PER_SHARD = 5000              # documents per training shard
SHUFFLE_SEED = 42
MAX_CHARS = 1_000_000_000          # tokenizer training character budget
DOC_CAP = 10_000                   # characters per document for tokenizer training
PACK_BUFFER = 1000                 # documents kept in the best-fit buffer
H100_BF16_PEAK_FLOPS = 989.5e12
EMA_BETA = 0.9
WARMUP_STEPS = 10                  # steps excluded from the training clock
MIN_DOC_CHARS = 100                # case reports: keep length > 100
MIN_REPORT_CHARS = 80              # pathology reports: keep length > 80 after strip
MIN_CASE_FIELD_CHARS = 20          # JSON case fields: stripped length > 20
LABEL_MAX = 45                     # labels longer than this are shortened ...
LABEL_KEEP = 42                    # ... to this many characters plus "..."
NEAR_BASELINE_MARGIN = 0.0005
AXIS_MARGIN = 0.15
SUSPECT_FILE_BYTES = 10_000
RUN_TIMEOUT_SECONDS = 600
LOSS_LIMIT = 100.0
TAIL_LINES = 50
WARMUP_RATIO = 0.0
WARMDOWN_RATIO = 0.3
FINAL_LR_FRAC = 0.0
WEIGHT_DECAY = 0.2
MUON_MOMENTUM_START = 0.85
MUON_MOMENTUM_END = 0.95
MUON_MOMENTUM_STEPS = 300
TOTAL_BATCH_SIZE = 2 ** 16

# --- fixed values: tokenizer ----------------------------------------------------------
# GPT-4 style split pattern with \p{N}{1,2}
SPLIT_PATTERN = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
SPECIAL_TOKENS = ["<|reserved_0|>", "<|reserved_1|>", "<|reserved_2|>", "<|reserved_3|>"]
BOS_TOKEN = "<|reserved_0|>"
ROUNDTRIP_SAMPLE = "Hello world! Numbers: 123. Unicode: 你好"

# --- fixed values: case-report keyword filter (lower-cased substring match) -----------
IBD_KEYWORDS = [
    "inflammatory bowel disease",
    "crohn's disease", "crohn disease", "crohns disease",
    "ulcerative colitis",
    "indeterminate colitis",
    " ibd ",
    "ileocolitis",
    "proctocolitis",
    "pouchitis",
    "ileitis",
    "colitis",
]

# --- fixed values: text column choice --------------------------------------------------
# a column is a text column when its lower-cased name contains one of these words
TEXT_COLUMN_WORDS = [
    "abstract", "background", "case_presentation", "case presentation",
    "clinical presentation", "discussion", "conclusion", "text",
    "body", "history", "findings", "report",
]
# JSON case keys, combined in this order
CASE_FIELD_KEYS = ["abstract", "background", "case_presentation", "discussion",
                   "conclusion", "text", "body", "clinical_presentation"]
# report tables: the first of these names present is the text column
REPORT_COLUMN_CANDIDATES = [
    "report_text", "text", "path_report", "pathology_report",
    "report", "narrative", "diagnosis", "findings", "abstract",
    "case_text", "clinical_text",
]
# deposit records: only these files are fetched
DEPOSIT_TEXT_FILES = ["cases.parquet", "abstracts.parquet"]
SUSPECT_CONTENT_TYPES = ["json", "html"]
# a zip member is read when its name ends with one of these
ZIP_MEMBER_SUFFIXES = (".csv", ".tsv", ".json")

# --- fixed values: pandas' default missing-value words (read_csv) ----------------------
NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
            "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
            "nan", "null"]

# --- fixed values: experiment log ------------------------------------------------------
STATUS_KEEP, STATUS_DISCARD, STATUS_CRASH = "KEEP", "DISCARD", "CRASH"
# the line a run prints at each step, and its fields
STEP_LINE = ("\rstep %05d (%.1f%%) | loss: %.6f | lrm: %.2f | dt: %.0fms | tok/sec: %,d | "
             "mfu: %.1f%% | epoch: %d | remaining: %.0fs    ")
STEP_FIELDS = {
    "step": (r"step (\d+)", "long"),
    "pct": (r"step \d+ \(([0-9.]+)%\)", "double"),
    "loss": (r"loss: ([-0-9.eE+naif]+)", "double"),
    "lrm": (r"lrm: ([-0-9.]+)", "double"),
    "dt_ms": (r"dt: ([0-9.]+)ms", "double"),
    "tok_sec": (r"tok/sec: ([0-9,]+)", "long"),
    "mfu": (r"mfu: ([0-9.]+)%", "double"),
    "epoch": (r"epoch: (\d+)", "long"),
    "remaining": (r"remaining: ([0-9.]+)s", "double"),
}
# the lines of the summary block
SUMMARY_LINES = {
    "val_bpb": "val_bpb:          %.6f", "training_seconds": "training_seconds: %.1f",
    "total_seconds": "total_seconds:    %.1f", "peak_vram_mb": "peak_vram_mb:     %.1f",
    "mfu_percent": "mfu_percent:      %.2f", "total_tokens_M": "total_tokens_M:   %.1f",
    "num_steps": "num_steps:        %d", "num_params_M": "num_params_M:     %.1f", "depth": "depth:            %d",
}
SUMMARY_KEYS = ["val_bpb", "training_seconds", "total_seconds", "peak_vram_mb",
                "mfu_percent", "total_tokens_M", "num_steps", "num_params_M", "depth"]

# --- fixed values: sandbox path policy (profile lists, $HOME unexpanded) -------------
# (folders of the corpora and of the checkout under neutral names)
POLICY_ALLOW = ["$HOME/research-loop", "$HOME/.cache/research/cases", "$HOME/.cache/research/reports",
                "$HOME/.cache/research/web", "$HOME/.cache/torch", "$HOME/.cache/uv",
                "$HOME/.cache/huggingface", "$HOME/.local/share/uv", "$HOME/.nv", "$HOME/.triton/cache",
                "/tmp", "/dev/shm", "/proc/self/task"]
POLICY_READ = ["/proc/driver/nvidia", "/proc/meminfo", "/proc/cpuinfo", "/proc/self", "/proc/version",
               "/proc/sys/vm/overcommit_memory", "$HOME/shared-libs", "$HOME/.nvm", "$HOME/.local/bin",
               "/usr/include", "/usr/local/cuda/include", "/usr/local/cuda/bin", "/sys/bus/pci", "/sys/devices",
               "/sys/module/nvidia"]
NO_DENIALS = "no denials recorded"
EPHEMERAL_PROC = r"^/proc/[0-9]+(/.*)?$"
