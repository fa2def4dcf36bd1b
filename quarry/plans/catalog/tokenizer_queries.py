"""Queries for the pre-tokenizer and the tokenizer."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import normalize_ws
from quarry.operators.pretokenize import pretoken_counts
from quarry.plans import sqltext as S
from quarry.plans.registry import register
from quarry.session import cut_lineage, read_table, spread, table_path


@register("pretoken_counts", sql=f"""
SELECT piece, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest({S.pieces(S.normalize_ws('text'))}) AS piece FROM documents)
GROUP BY piece
""")
def q_pretoken_counts(spark, sf_dir):
    """C8 piece frequencies of every document, on whitespace-normalised text (H1 + C8)."""
    docs = spread(read_table(spark, sf_dir, "documents", "text"))
    return pretoken_counts(docs.select(normalize_ws("text").alias("text")))


@register("pretoken_counts_raw")
def q_pretoken_counts_raw(spark, sf_dir):
    """C8 piece frequencies of the raw text with the full pattern (look-ahead, possessive)."""
    docs = spread(read_table(spark, sf_dir, "documents", "text"))
    return pretoken_counts(docs)


# --------------------------------------------------------------------------- tokenizer
from quarry.constants import BOS_TOKEN, EVAL_TOKENS, MAX_SEQ_LEN, VOCAB_SIZE  # noqa: E402
from quarry.operators import bpe, metrics, packing  # noqa: E402

QUERY_VOCAB = VOCAB_SIZE   # 256 bytes + 7,932 merges + 4 specials
PACK_T = MAX_SEQ_LEN       # rows of T + 1 = 2049 ids, as the reference packs
PACK_BUFFER_DOCS = 1000
BATCH = 16                 # the reference's device batch
# One training per process, table version and size.
_TOKENIZERS: dict[tuple, bpe.Tokenizer] = {}


def train_split(spark, sf_dir):
    from quarry.plans.catalog.corpus_queries import assigned_docs
    a = assigned_docs(spark, sf_dir)
    return a.where(F.col("split") == "train"), a.where(F.col("split") == "val")


def table_version(spark, path: str) -> tuple:
    """Names, sizes and times of a table's files: what changes when the table does."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [fs.getFileStatus(at)]
    if found[0].isDirectory():
        found = fs.listStatus(at)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))


def tokenizer(spark, sf_dir, vocab: int = QUERY_VOCAB) -> bpe.Tokenizer:
    """H2 on the training split (whole texts), trained once per process and version of the table;
    the merge list, which needs no session, is bounded by the vocabulary size.  An empty split stops
    the job."""
    key = (vocab, table_version(spark, table_path(sf_dir, "documents")))
    if key not in _TOKENIZERS:
        train, _ = train_split(spark, sf_dir)
        if train.limit(1).count() == 0:
            raise ValueError("the training split is empty")
        _TOKENIZERS[key] = bpe.train_bpe(spark, train.select("text"), vocab_size=vocab)
    return _TOKENIZERS[key]


@register("bpe_pair_counts", sql=f"""
WITH pieces AS (SELECT piece, CAST(count(*) AS BIGINT) AS n
                FROM (SELECT unnest({S.pieces(S.normalize_ws('text'))}) AS piece FROM documents) GROUP BY piece),
hexed AS (SELECT hex(encode(piece)) AS h, strlen(piece) AS nb, n FROM pieces WHERE strlen(piece) >= 2)
SELECT CAST(('0x' || substr(h, 2 * i + 1, 2))::INTEGER AS INTEGER) AS "left",
       CAST(('0x' || substr(h, 2 * i + 3, 2))::INTEGER AS INTEGER) AS "right",
       CAST(sum(n) AS BIGINT) AS n
FROM (SELECT h, n, unnest(range(nb - 1)) AS i FROM hexed) GROUP BY 1, 2""")
def q_bpe_pair_counts(spark, sf_dir):
    """The first round of BPE training — weighted byte-pair counts over all pieces of
    whitespace-normalised documents."""
    docs = spread(read_table(spark, sf_dir, "documents", "text"))
    counts = pretoken_counts(docs.select(normalize_ws("text").alias("text")))
    return bpe.pair_counts(bpe.word_table(counts))


@register("train_bpe")
def q_train_bpe(spark, sf_dir):
    """H2 + M7: the learnt merges (rank, left, right, new id) of the training split."""
    return bpe.merges_frame(spark, tokenizer(spark, sf_dir))


@register("vocab_table")
def q_vocab_table(spark, sf_dir):
    """H3 + H4: vocabulary with decoded byte lengths (specials 0, last ids)."""
    return bpe.vocab_frame(spark, tokenizer(spark, sf_dir))


@register("vocab_size", sql=f"SELECT CAST({QUERY_VOCAB} AS BIGINT) AS vocab_size, {QUERY_VOCAB - 4} AS bos_id")
def q_vocab_size(spark, sf_dir):
    """H9: vocabulary size and the BOS id, from the vocabulary table."""
    v = bpe.vocab_frame(spark, tokenizer(spark, sf_dir))
    bos = F.lit(BOS_TOKEN).cast("binary")
    return v.agg(F.count(F.lit(1)).alias("vocab_size"),
                 F.max(F.when(F.col("is_special") & (F.col("token") == bos), F.col("token_id"))).alias("bos_id"))


def encoded_docs(spark, sf_dir, split: str = "train", bos: bool = True):
    train, val = train_split(spark, sf_dir)
    docs = train if split == "train" else val
    return bpe.encode(docs.select("doc_id", "idx", "text"), tokenizer(spark, sf_dir), prepend_bos=bos)


def all_documents_encoded(spark, sf_dir, bos: bool):
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return bpe.encode(docs, tokenizer(spark, sf_dir), prepend_bos=bos)


@register("encode")
def q_encode(spark, sf_dir):
    """H5: token ids of every document of the table (ids, count, bytes)."""
    e = all_documents_encoded(spark, sf_dir, bos=False)
    return e.select("doc_id", "ids", F.size("ids").alias("n_tokens"), F.octet_length("text").alias("n_bytes"))


@register("encode_prepend_bos")
def q_encode_bos(spark, sf_dir):
    """H6: ids of every document with BOS in front."""
    e = all_documents_encoded(spark, sf_dir, bos=True)
    return e.select("doc_id", "ids", F.size("ids").alias("n_tokens"))


@register("decode", sql="SELECT doc_id, text AS decoded FROM documents")
def q_decode(spark, sf_dir):
    """H7: ids of every document decoded back to text."""
    e = all_documents_encoded(spark, sf_dir, bos=False)
    return bpe.decode(e, tokenizer(spark, sf_dir)).select("doc_id", "decoded")


@register("roundtrip_check", sql="""
SELECT text = text AS roundtrip_ok, CAST(count(*) AS BIGINT) AS n_docs FROM documents GROUP BY 1""")
def q_roundtrip(spark, sf_dir):
    """H8: decode(encode(text)) == text for every document of the table."""
    docs = spread(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return bpe.roundtrip_check(docs, tokenizer(spark, sf_dir)) \
              .groupBy("roundtrip_ok").agg(F.count(F.lit(1)).alias("n_docs"))


def packed(spark, sf_dir, split: str = "train", epochs: int = 1):
    return packing.pack_best_fit(encoded_docs(spark, sf_dir, split, bos=True), PACK_T, PACK_BUFFER_DOCS, order="idx", epochs=epochs)


@register("pack_best_fit")
def q_pack_best_fit(spark, sf_dir):
    """Best-fit rows of T+1 = 2049 ids per pack (buffer 1,000 documents)."""
    return packed(spark, sf_dir)


@register("shift_targets")
def q_shift_targets(spark, sf_dir):
    """Inputs and targets of every packed row."""
    return packing.shift_targets(packed(spark, sf_dir), PACK_T).select("pack_id", "row", "inputs", "targets")


@register("batch_rows")
def q_batch_rows(spark, sf_dir):
    """I4: B = 16 rows per batch."""
    return packing.batch_rows(packed(spark, sf_dir), BATCH).select("pack_id", "row", "batch")


@register("pack_utilization")
def q_pack_utilization(spark, sf_dir):
    """Ids that came in, placed and cropped ids of the packer, in one pass."""
    return packing.pack_utilization(packed(spark, sf_dir))


@register("repeat_epochs")
def q_repeat_epochs(spark, sf_dir):
    """Two passes over the validation split through one buffer a pack; rows by the epoch of
    their first document."""
    return packed(spark, sf_dir, "val", epochs=2).groupBy("epoch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("tokens")).cast("long").alias("n_ids"))


@register("eval_steps", sql=f"""
SELECT CAST(range AS BIGINT) AS eval_row, CAST(range // {BATCH} AS BIGINT) AS step, {PACK_T + 1} AS n_ids, true AS bos_first
FROM range({EVAL_TOKENS // (BATCH * PACK_T) * BATCH})""")
def q_eval_steps(spark, sf_dir):
    """The validation rows one evaluation reads — EVAL_TOKENS // (B·T) = 640 batches of
    16 rows — wrapping round the validation split as often as that takes, each pack replayed in place."""
    need = EVAL_TOKENS // (BATCH * PACK_T) * BATCH
    rows = packing.pack_best_fit(encoded_docs(spark, sf_dir, "val", bos=True), PACK_T, PACK_BUFFER_DOCS, order="idx", rows_wanted=need)
    rows = packing.eval_rows(cut_lineage(rows, "eval-rows"), BATCH, PACK_T, EVAL_TOKENS)
    bos = tokenizer(spark, sf_dir).bos_id
    return rows.select("eval_row", "step", F.size("tokens").alias("n_ids"), (F.get("tokens", F.lit(0)) == bos).alias("bos_first"))


@register("bits_per_byte_tokens")
def q_bpb_tokens(spark, sf_dir):
    """C10 (+ G1): BPB of validation tokens under add-one unigram losses learnt from the
    training tokens, through the vocabulary's byte lengths (specials count 0)."""
    tok = tokenizer(spark, sf_dir)
    from quarry.plans.catalog.corpus_queries import assigned_docs
    both = bpe.encode(assigned_docs(spark, sf_dir).select("split", "text"), tok, prepend_bos=True)
    counts = cut_lineage(both.select("split", F.explode("ids").alias("token_id"))
                         .groupBy("split", "token_id").agg(F.count(F.lit(1)).alias("c")))
    tc = counts.where("split = 'train'").drop("split")
    tot = tc.agg(F.sum("c").alias("N"), F.count(F.lit(1)).alias("V")).first()
    denom = float(tot["N"] + tot["V"] + 1)
    vc = counts.where("split = 'val'").select("token_id", F.col("c").alias("m"))
    scored = vc.join(tc, "token_id", "left").select(
        "token_id", (F.col("m") * -F.log((F.coalesce("c", F.lit(0)) + 1) / F.lit(denom))).alias("nll"))
    return metrics.bits_per_byte(scored, bpe.vocab_frame(spark, tok))


def _bpb_sql():
    from quarry.plans.catalog.corpus_queries import SHARD_SQL
    return SHARD_SQL + f""",
p AS (SELECT split, unnest({S.pieces(S.normalize_ws('text'))}) AS piece FROM asg),
tc AS (SELECT piece, count(*) AS c FROM p WHERE split = 'train' GROUP BY piece),
tot AS (SELECT sum(c) AS nn, count(*) AS vv FROM tc),
vc AS (SELECT piece, count(*) AS m FROM p WHERE split = 'val' GROUP BY piece),
agg AS (SELECT sum(CASE WHEN strlen(piece) > 0 THEN m * -ln((coalesce(c, 0) + 1) / (nn + vv + 1)) ELSE 0 END) AS total_nats,
               CAST(sum(m * strlen(piece)) AS BIGINT) AS total_bytes, CAST(sum(m) AS BIGINT) AS n_tokens
        FROM vc LEFT JOIN tc USING (piece) CROSS JOIN tot)
SELECT total_nats, total_bytes, n_tokens, total_nats / (ln(2) * total_bytes) AS bpb FROM agg"""


@register("bits_per_byte", sql=_bpb_sql())
def q_bits_per_byte(spark, sf_dir):
    """C10 stand-in with an oracle: add-one unigram BPB over the pieces of whitespace-
    normalised text, learnt on the train split and scored on the validation split."""
    from quarry.operators.pretokenize import pieces_expr
    from quarry.plans.catalog.corpus_queries import assigned_docs
    a = assigned_docs(spark, sf_dir).select("split", normalize_ws("text").alias("text"))
    ex = a.select("split", F.explode(pieces_expr("text")).alias("piece"))
    return metrics.unigram_bpb(ex)


# --------------------------------------------------------------------------- conservation
# What cannot be computed in SQL is held against what SQL knows must be true of it.

def _raw_bytes(tok: bpe.Tokenizer):
    """Bytes of the ids in ``ids``; specials have none (a literal of one number per vocabulary entry)."""
    sizes = F.expr(f"array({','.join(str(len(b)) for b in tok.token_bytes())}{',0' * len(tok.specials)})")
    return F.aggregate("ids", F.lit(0).cast("long"), lambda a, i: a + F.element_at(sizes, i + 1))


@register("pretokenize_conservation", sql="SELECT doc_id, md5(text) AS joined_md5, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def q_pretokenize_conservation(spark, sf_dir):
    """H1 on raw text: the pieces of every document joined are the document."""
    from quarry.operators.pretokenize import pretokenize
    d = pretokenize(spread(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    n = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p))
    return d.select("doc_id", F.md5(F.array_join("pieces", "")).alias("joined_md5"), n.alias("n_bytes"))


@register("merges_conservation", sql=f"""
SELECT CAST(range AS INTEGER) AS rank, CAST(256 + range AS INTEGER) AS new_id, true AS known FROM range({QUERY_VOCAB - 260})""")
def q_merges_conservation(spark, sf_dir):
    """H2: ranks dense from 0, new ids dense from 256, each made of earlier ids."""
    m = bpe.merges_frame(spark, tokenizer(spark, sf_dir))
    return m.select("rank", "new_id", (F.greatest("left", "right") < F.col("new_id")).alias("known"))


@register("vocab_conservation", sql=f"""
SELECT CAST(range AS INTEGER) AS token_id, range >= {QUERY_VOCAB - 4} AS is_special, range >= {QUERY_VOCAB - 4} AS no_bytes
FROM range({QUERY_VOCAB})""")
def q_vocab_conservation(spark, sf_dir):
    """H3 + H4: ids dense from 0, the specials last, and they alone have no bytes."""
    v = bpe.vocab_frame(spark, tokenizer(spark, sf_dir))
    return v.select("token_id", "is_special", (F.col("n_bytes") == 0).alias("no_bytes"))


@register("save_vocab", sql=f"""
SELECT CAST(range AS INTEGER) AS token_id, range >= {QUERY_VOCAB - 4} AS is_special, true AS same FROM range({QUERY_VOCAB})""")
def q_save_vocab(spark, sf_dir):
    """The tokenizer saved as tables and loaded again has the same vocabulary."""
    from quarry.session import shared_folder
    from quarry.sources.vocab_io import load_tokenizer, save_tokenizer
    tok, root = tokenizer(spark, sf_dir), shared_folder(spark, "tokenizer")
    save_tokenizer(spark, tok, root)
    old = bpe.vocab_frame(spark, tok).select("token_id", F.col("token").alias("old"))
    new = bpe.vocab_frame(spark, load_tokenizer(spark, root))
    return new.join(old, "token_id").select("token_id", "is_special", (F.col("token") == F.col("old")).alias("same"))


@register("encode_conservation", sql="""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, CAST(strlen(text) AS BIGINT) AS n_bytes_bos, true AS bos_first,
       CAST(1 AS BIGINT) AS n_bos FROM documents""")
def q_encode_conservation(spark, sf_dir):
    """H5 + H6: the bytes of a document's ids are the document's bytes; BOS stands first and only there."""
    tok = tokenizer(spark, sf_dir)
    plain = all_documents_encoded(spark, sf_dir, bos=False).select("doc_id", _raw_bytes(tok).alias("n_bytes"))
    bos = all_documents_encoded(spark, sf_dir, bos=True).select(
        "doc_id", _raw_bytes(tok).alias("n_bytes_bos"), (F.get("ids", F.lit(0)) == tok.bos_id).alias("bos_first"),
        F.size(F.filter("ids", lambda i: i == tok.bos_id)).cast("long").alias("n_bos"))
    return plain.join(bos, "doc_id")


def _pack_checks(rows, bos: int):
    """What must hold of packed rows: full ones have T + 1 ids, every row starts with BOS, the split has
    one short row at most, all ids are placed or cropped; and the documents that came in."""
    docs = F.sum(F.size(F.filter("tokens", lambda i: i == bos)))
    return rows.agg(F.min(F.col("complete") == (F.size("tokens") == PACK_T + 1)).alias("full"),
                    F.min(F.get("tokens", F.lit(0)) == bos).alias("bos_first"),
                    (F.count_if(~F.col("complete")) <= 1).alias("one_short"),
                    (F.sum(F.size("tokens")) + F.sum("cropped") == F.sum("pack_input")).alias("conserved"),
                    docs.cast("long").alias("n_docs"))


def _pack_sql(split: str, times: int, more: str = "") -> str:
    from quarry.plans.catalog.corpus_queries import SHARD_SQL
    return SHARD_SQL + f"""
SELECT true AS full, true AS bos_first, true AS one_short, true AS conserved{more}, CAST({times} * count(*) AS BIGINT) AS n_docs
FROM asg WHERE split = '{split}'"""


@register("pack_conservation", sql=_pack_sql("train", 1, ", true AS shifted, true AS batched"))
def q_pack_conservation(spark, sf_dir):
    """I3 + C12 + B19 + I4: the packer loses no id and no document; targets are the inputs one step
    on; batches number the rows of a pack by B."""
    rows = cut_lineage(packed(spark, sf_dir))
    t = packing.batch_rows(packing.shift_targets(rows.where("complete"), PACK_T), BATCH)
    ok = (F.slice("inputs", 2, PACK_T - 1) == F.slice("targets", 1, PACK_T - 1)) & (F.size("targets") == PACK_T)
    t = t.agg(F.min(ok).alias("shifted"), F.min((F.col("row") - F.col("batch") * BATCH).between(0, BATCH - 1)).alias("batched"))
    return _pack_checks(rows, tokenizer(spark, sf_dir).bos_id).join(F.broadcast(t))     # one row each


@register("epochs_conservation", sql=_pack_sql("val", 3))
def q_epochs_conservation(spark, sf_dir):
    """I2 + I3: three epochs of the validation split, replayed in each pack: every document comes in
    three times and the split still has one short row at most."""
    return _pack_checks(cut_lineage(packed(spark, sf_dir, "val", epochs=3)), tokenizer(spark, sf_dir).bos_id)


@register("bits_per_byte_scored", sql="""
WITH s AS (SELECT source, doc_id % 300 AS token_id, ln(n_chars + 1) AS nll FROM documents),
v AS (SELECT DISTINCT token_id, CASE WHEN token_id < 280 THEN token_id % 5 END AS n_bytes FROM s)
SELECT source, sum(CASE WHEN n_bytes > 0 THEN nll ELSE 0.0 END) AS total_nats, CAST(sum(coalesce(n_bytes, 0)) AS BIGINT) AS total_bytes,
       CAST(count(*) AS BIGINT) AS n_tokens,
       sum(CASE WHEN n_bytes > 0 THEN nll ELSE 0.0 END) / (ln(2) * sum(coalesce(n_bytes, 0))) AS bpb
FROM s JOIN v USING (token_id) GROUP BY source""")
def q_bits_per_byte_scored(spark, sf_dir):
    """C10 on a scored table that SQL can build too (stand-in: a document is a token, its id the
    token id, the logarithm of its length the loss); tokens without bytes and tokens that the
    vocabulary lacks count in neither sum."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    scored = d.select("source", (F.col("doc_id") % 300).alias("token_id"), F.log(F.col("n_chars") + 1.0).alias("nll"))
    vocab = scored.select("token_id").distinct().where("token_id < 280").withColumn("n_bytes", (F.col("token_id") % 5).cast("int"))
    return metrics.bits_per_byte(scored, vocab, ["source"])
