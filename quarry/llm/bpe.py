"""Byte-level BPE by a sentencepiece model that is serialised directly from a rank file.

Each byte is mapped to one character of a block of 256 code points, so every vocabulary entry
becomes an ordinary piece; its score is its negative rank, so sentencepiece merges the pair of
lowest rank first and the leftmost of equals, which is the merge order of the ranks.  The
normaliser is the identity: no dummy prefix, no white-space rules.  Text is split by the
pre-token pattern, each pre-token is encoded on its own, and ids decode by the inverse map.

Entries that their own merges cannot reach are found once (each piece is encoded) and looked
up as whole pre-tokens, as rank-based encoders do."""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import list_array, map_arrow, slices, texts

# Braille patterns: exactly 256 code points, none of them white space.
FIRST_BYTE_CHAR = 0x2800
BYTE_CHARS = {b: FIRST_BYTE_CHAR + b for b in range(256)}
# Between a non-space and a single space before another non-space the pre-token pattern always
# starts a new match, so the pieces on both sides do not depend on each other.
CUT = re.compile(r"(?<=\S)(?= \S)")
CACHE_ENTRIES = 250_000             # of each of two caches: about 70 MB a worker
CACHED_CHARS = 40
DECODED_ROWS = 1000


@dataclass(frozen=True)
class BpeModel:
    """A serialised sentencepiece model with what decoding needs; about 2 MB for 50,000 ranks."""
    proto: bytes
    pieces: tuple[bytes, ...]          # bytes of the i-th piece
    ids: tuple[int, ...]               # token id (rank) of the i-th piece
    unreachable: dict[bytes, int]      # whole pre-tokens whose merges do not lead to their entry
    pattern: str


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_text(raw: bytes) -> str:
    return raw.decode("latin-1").translate(BYTE_CHARS)


def build_model(ranks: dict[bytes, int], pattern: str) -> BpeModel:
    """Serialise the vocabulary as a sentencepiece BPE model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    order = sorted(ranks.items(), key=lambda kv: kv[1])
    m = pb.ModelProto()
    for raw, rank in order:
        p = m.pieces.add()
        p.piece, p.score, p.type = byte_text(raw), -float(rank), pb.ModelProto.SentencePiece.NORMAL
    unk = m.pieces.add()
    unk.piece, unk.score, unk.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    t = m.trainer_spec
    t.model_type, t.vocab_size = pb.TrainerSpec.BPE, len(m.pieces)
    t.unk_id, t.bos_id, t.eos_id, t.pad_id = len(order), -1, -1, -1
    n = m.normalizer_spec
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    proto = m.SerializeToString()
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    own = sp.encode([byte_text(raw) for raw, _ in order], num_threads=1)
    off = {raw: rank for i, (raw, rank) in enumerate(order) if own[i] != [i]}
    return BpeModel(proto, tuple(r for r, _ in order), tuple(i for _, i in order), off, pattern)


class Encoder(dict):
    """Chunk of text → its ids as little-endian int32 bytes, kept in a bounded cache."""

    def __init__(self, model: BpeModel):
        import regex
        import sentencepiece
        super().__init__()
        self.model = model
        self.split = regex.compile(model.pattern).findall
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
        self.of_piece = np.array(model.ids, "<i4")
        self.words: dict[str, bytes] = {}

    def pretoken(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        whole = self.model.unreachable.get(raw)
        if whole is not None:
            return np.array([whole], "<i4").tobytes()
        return self.of_piece[self.sp.encode(byte_text(raw))].tobytes()

    def __missing__(self, chunk: str) -> bytes:
        words, out = self.words, []
        for w in self.split(chunk):
            ids = words.get(w)
            if ids is None:
                ids = self.pretoken(w)
                if len(w) <= CACHED_CHARS:
                    if len(words) >= CACHE_ENTRIES:
                        words.clear()
                    words[w] = ids
            out.append(ids)
        found = b"".join(out)
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = found
        return found

    def forget(self) -> None:
        """Empty the caches: the worker's next task may be another operator's."""
        self.clear()
        self.words.clear()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, CUT.split(text))) if text else b""


class Decoder(dict):
    """Id → its bytes; needs no sentencepiece."""

    def __init__(self, model: BpeModel):
        super().__init__(zip(model.ids, model.pieces))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.__getitem__, ids))


_CODERS: dict[tuple, Encoder | Decoder] = {}   # one of each per Python worker and model


def coder(kind: type, model: Broadcast) -> Encoder | Decoder:
    at = kind, hash(model.value.proto)
    if at not in _CODERS:
        _CODERS[at] = kind(model.value)
    return _CODERS[at]


def load_model(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The model of a rank file, broadcast (its size is bounded by the vocabulary)."""
    return spark.sparkContext.broadcast(build_model(read_ranks(path), pattern))


def _encoding(model: Broadcast, key: str):
    """Batches of ``_key, _text`` → batches of ``key, token_ids``."""
    def run(batches):
        enc = coder(Encoder, model)
        for b in slices(batches, "_text"):
            found = [enc.encode(t) for t in texts(b.column("_text"))]
            values = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [b.column("_key"), list_array([len(x) // 4 for x in found], values)], [key, "token_ids"])
        enc.forget()
    return run


def _decoding(model: Broadcast, keep: list[str], ids: str, out: str):
    """Batches of ``keep`` → the same with the bytes ``out`` of their ``ids``."""
    def run(batches):
        dec = coder(Decoder, model)
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                b = batch.slice(start, DECODED_ROWS)
                col = b.column(ids)
                values, offs = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
                raw = [dec.decode(values[s:e].tolist()) for s, e in zip(offs[:-1], offs[1:])]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], [*keep, out])
    return run


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))


def encode(docs: DataFrame, model: Broadcast, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, token_ids`` for every row of ``docs``; other columns are left behind, so none can
    clash.  A null or empty text has no ids; repeated rows and null keys stay as they are; a very
    long text is one row, encoded whole.  Without rows the result has none."""
    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(_keyed(docs, text, key), _encoding(model, key), f"`{key}` {kind}, token_ids array<int>")


def decode(tokens: DataFrame, model: Broadcast, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that ``ids`` decode to (``out`` replaces a column of that name).
    Null ids decode to no bytes."""
    keep = [c for c in tokens.columns if c != out]
    src = tokens.select(*keep)
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.BinaryType())])
    return map_arrow(src, _decoding(model, keep, ids, out), schema)


def encode_and_decode(docs: DataFrame, model: Broadcast, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``decode(encode(docs))`` with both steps of a row in one Python worker: one after the other they hold two
    workers a core at once, each with a model."""
    kind = docs.schema[key].dataType.simpleString()
    encoding, decoding = _encoding(model, key), _decoding(model, [key, "token_ids"], "token_ids", "decoded")
    return map_arrow(_keyed(docs, text, key), lambda batches: decoding(encoding(batches)),
                     f"`{key}` {kind}, token_ids array<int>, decoded binary")


def digests(tokens: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of ``token_ids`` and ``decoded``, then the columns ``more``."""
    ids = F.coalesce("token_ids", F.array().cast("array<int>"))
    return tokens.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)


