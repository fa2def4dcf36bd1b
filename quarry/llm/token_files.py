"""Token ids in Arrow files of fixed-size-list batches.

A shard is two Arrow IPC files (the stream format with a footer of block offsets):

* ``tokens-NNNNN.arrow``: ``input_ids fixed_size_list<uint16 or uint32>[seq_len]`` and
  ``mask fixed_size_list<bool>[seq_len]``.  The ids of the shard's documents follow each other
  through equal-length sequences; only the end of the last sequence is padding (mask false).
  Every batch but the last has ``batch_rows`` sequences, so sequence ``i`` is row
  ``i % batch_rows`` of batch ``i // batch_rows``: a memory-mapped reader hands out NumPy views
  of the file without a copy.
* ``docs-NNNNN.arrow``: ``key, start, n_tokens`` of the shard's documents in order.

Shards are the range partitions of the key, so their numbers ascend with it.  A task writes
under a name of its own and renames at the end: a retried task replaces its shard with the same
bytes and a lost one leaves nothing under the final name."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, shared_path, slices, texts, written

SEQ_LEN = 2048
BATCH_ROWS = 256
CACHE_ENTRIES = 1_200_000           # about 200 MB a worker
CACHED_CHARS = 40


def filesystem(uri: str):
    """The Arrow file system of a folder URI and the path in it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# Between a stop and a letter or digit before it that no normal form takes apart, pre-tokens end.
STOPS = frozenset(".,;:!?")
PLAIN = frozenset(c for c in map(chr, range(256)) if c in "0123456789" or c.isalpha() and (c.isascii() or c >= "À"))
SPLIT_MARK = "\0"                      # encodes to one id that no other chunk can give
JOINED = 64


class WordEncoder(dict):
    """White-space-free chunk → ids as little-endian int bytes, with a bounded cache.

    A special string of the vocabulary, as it is written there, is its one id wherever it stands in a
    text, as in the library; texts are cut at such strings before anything else.

    The tokenizer drops white space and its splits, merges and normal forms never cross a space
    or a line end, so the chunks between these encode on their own.  A new chunk that is a known word
    and a stop has the ids of both; others are encoded many at a time, parted by a mark of one id."""

    def __init__(self, spec: str, width: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.t = Tokenizer.from_str(spec)
        self.width, self.size = width, np.dtype(width).itemsize
        specials = {t.content: i for i, t in self.t.get_added_tokens_decoder().items() if t.special and not t.normalized}
        # A chunk has no space in it, so these keys are nobody else's.
        self.special = {f" {c}": np.array([i], width).tobytes() for c, i in specials.items()}
        self.hint = os.path.commonprefix(list(specials))
        self.cut = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")
        self.t.encode_special_tokens = True   # what is left of a text, and its lower case, is ordinary
        self._forget()
        self.mark = self.t.encode(SPLIT_MARK, add_special_tokens=False).ids
        assert len(self.mark) == 1

    def _forget(self) -> None:
        self.clear()
        self.update(self.special | {"": b""})

    def _chunks(self, text: str) -> list[str]:
        return (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")

    def _parts(self, text: str) -> list[str]:
        """Chunks of a text; special strings are the keys of ``special``."""
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._chunks(text[at:m.start()])
            out.append(f" {m[0]}")
            at = m.end()
        return out + self._chunks(text[at:])

    def _learn(self, chunks: list[str]) -> None:
        odd = [c for c in chunks if SPLIT_MARK in c]
        for c, e in zip(odd, self.t.encode_batch_fast(odd, add_special_tokens=False)):
            self[c] = np.array(e.ids, self.width).tobytes()
        plain = [c for c in chunks if SPLIT_MARK not in c]
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        sep = f" {SPLIT_MARK} "
        for g, e in zip(groups, self.t.encode_batch_fast([sep.join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids + self.mark, self.width)
            raw, start = ids.tobytes(), 0
            for c, at in zip(g, (np.flatnonzero(ids == self.mark[0]) * self.size).tolist()):
                self[c] = raw[start:at]
                start = at + self.size

    def encode(self, docs: list[str]) -> list[bytes]:
        if len(self) > CACHE_ENTRIES:
            self._forget()
        parts = [self._parts(d) if self.hint in d else self._chunks(d) for d in docs]
        known = [list(map(self.get, p)) for p in parts]
        gaps = [i for i, k in enumerate(known) if None in k]
        missing = {c for i in gaps for c, b in zip(parts[i], known[i]) if b is None}
        stopped = [c for c in missing if c[-1] in STOPS and len(c) > 1 and c[-2] in PLAIN]
        need = missing.difference(stopped)
        need.update(c for s in stopped for c in (s[:-1], s[-1]) if c not in self)
        self._learn(list(need))
        for c in stopped:
            self[c] = self[c[:-1]] + self[c[-1]]
        for i in gaps:
            known[i] = [self[c] if b is None else b for c, b in zip(parts[i], known[i])]
        out = list(map(b"".join, known))
        for c in missing | need:
            if len(c) > CACHED_CHARS:
                del self[c]
        return out


_ENCODERS: dict[int, WordEncoder] = {}


def word_encoder(spec: Broadcast, width: str) -> WordEncoder:
    at = hash((spec.value, width))
    if at not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[at] = WordEncoder(spec.value, width)
    return _ENCODERS[at]


class ShardWriter:
    """Streams ids into one shard; memory holds one batch of sequences."""

    def __init__(self, folder: str, shard: int, width: str, key_type: pa.DataType, seq_len: int, batch_rows: int):
        self.fs, self.path = filesystem(folder)
        self.names = {k: f"{self.path}/{k}-{shard:05d}.arrow" for k in ("tokens", "docs")}
        self.temp = {k: f"{self.path}/_{k}-{shard:05d}-{uuid.uuid4().hex}" for k in self.names}
        self.fs.create_dir(self.path, recursive=True)
        self.width, self.seq_len, self.batch_rows = np.dtype(width), seq_len, batch_rows
        ids = pa.from_numpy_dtype(self.width)
        self.schema = pa.schema([("input_ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))],
                                {"seq_len": str(seq_len), "batch_rows": str(batch_rows)})
        self.doc_schema = pa.schema([("key", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.tokens_out, self.docs_out = (self.fs.open_output_stream(self.temp[k]) for k in ("tokens", "docs"))
        self.tokens = pa.ipc.new_file(self.tokens_out, self.schema)
        self.docs = pa.ipc.new_file(self.docs_out, self.doc_schema)
        self.pending, self.held, self.n = [], 0, 0

    def add(self, keys: pa.Array, blobs: list[bytes]) -> pa.RecordBatch:
        """Append documents; returns their index rows."""
        n = np.array([len(b) // self.width.itemsize for b in blobs], "int64")
        start = self.n + np.cumsum(n) - n
        index = pa.RecordBatch.from_arrays([keys, pa.array(start), pa.array(n)], schema=self.doc_schema)
        self.docs.write_batch(index)
        self.n += int(n.sum())
        self.pending += blobs
        self.held += sum(map(len, blobs))
        if self.held >= self.seq_len * self.batch_rows * self.width.itemsize:
            self._flush(False)
        return index

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), self.width)
        full = self.seq_len * self.batch_rows
        cut = len(ids) if last else len(ids) // full * full
        for at in range(0, cut, full):
            part = ids[at:min(at + full, cut)]
            rows = -(-len(part) // self.seq_len)
            mask = np.zeros(rows * self.seq_len, bool)
            mask[:len(part)] = True
            padded = np.zeros(rows * self.seq_len, self.width)
            padded[:len(part)] = part
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (padded, mask)]
            self.tokens.write_batch(pa.RecordBatch.from_arrays(cols, schema=self.schema))
        self.pending = [ids[cut:].tobytes()]
        self.held = len(self.pending[0])

    def close(self) -> None:
        self._flush(True)
        for w in (self.tokens, self.tokens_out, self.docs, self.docs_out):
            w.close()
        for k in self.names:
            self.fs.move(self.temp[k], self.names[k])


class Shard:
    """Random access to one shard; local files are memory-mapped."""

    def __init__(self, folder: str, shard: int):
        from pyarrow import fs
        store, path = filesystem(folder)
        local = isinstance(store, fs.LocalFileSystem)
        openf = (lambda p: pa.memory_map(p)) if local else store.open_input_file
        self.tokens = pa.ipc.open_file(openf(f"{path}/tokens-{shard:05d}.arrow"))
        self.docs = pa.ipc.open_file(openf(f"{path}/docs-{shard:05d}.arrow"))
        meta = self.tokens.schema.metadata
        self.seq_len, self.batch_rows = int(meta[b"seq_len"]), int(meta[b"batch_rows"])
        self._at, self._ids, self._batch = -1, None, None

    def _load(self, i: int) -> None:
        if i != self._at:
            self._batch = self.tokens.get_batch(i)
            self._at, self._ids = i, self._batch.column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of the i-th sequence."""
        self._load(i // self.batch_rows)
        s = slice(i % self.batch_rows * self.seq_len, (i % self.batch_rows + 1) * self.seq_len)
        mask = self._batch.column(1).flatten().slice(s.start, self.seq_len)
        return self._ids[s], mask.to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> np.ndarray:
        """Ids ``start … start + n`` of the shard; a view where they lie in one batch."""
        full, out, end = self.seq_len * self.batch_rows, [], start + n
        while start < end:
            self._load(start // full)
            stop = min(end, (start // full + 1) * full)
            out.append(self._ids[start % full:start % full + stop - start])
            start = stop
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, "uint16")

    def documents(self) -> Iterator[pa.RecordBatch]:
        return (self.docs.get_batch(i) for i in range(self.docs.num_record_batches))


def write_tokens(docs: DataFrame, folder: str, spec: Broadcast, end_id: int, width: str = "<u2",
                 text: str = "text", key: str = "doc_id", seq_len: int = SEQ_LEN,
                 batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Encode ``text`` and write the ids in ascending ``key`` order; returns the manifest
    ``key, shard, start, n_tokens`` (start within the shard), already written.

    Null and empty texts have only the end id.  Null keys come first; rows of one key follow
    each other in the order of their text.  Other columns are left behind.  Without rows there
    is no shard.  Very long texts are encoded whole."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], width).tobytes()

    def run(batches: Iterable[pa.RecordBatch]):
        out = None
        enc = word_encoder(spec, width)
        shard = TaskContext.get().partitionId()
        for b in slices(batches, "_text"):
            if out is None:
                out = ShardWriter(folder, shard, width, b.schema.field("_key").type, seq_len, batch_rows)
            index = out.add(b.column("_key"), [x + end for x in enc.encode(texts(b.column("_text")))])
            yield pa.RecordBatch.from_arrays(
                [index.column(0), pa.array([shard] * index.num_rows, pa.int32()), index.column(1), index.column(2)],
                ["_key", "shard", "start", "n_tokens"])
        if out is not None:
            out.close()

    rows = (docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
            .repartitionByRange(F.col("_key").asc_nulls_first())
            .sortWithinPartitions(F.col("_key").asc_nulls_first(), "_text"))
    return written(map_arrow(rows, run, f"_key {kind}, shard int, start bigint, n_tokens bigint")
                   .withColumnRenamed("_key", key), "token-manifest")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read every shard back: ``key, shard, start, n_tokens, ids_crc32`` from the files alone.
    The manifest says which shards there are."""
    kind = manifest.schema[key].dataType.simpleString()
    shards = manifest.select("shard").distinct()

    def run(batches):
        for b in batches:
            for shard in b.column(0).to_pylist():
                s = Shard(folder, shard)
                for index in s.documents():
                    spans = zip(index.column(1).to_pylist(), index.column(2).to_pylist())
                    crc = [zlib.crc32(s.span(at, n).astype("<u4").tobytes()) for at, n in spans]
                    yield pa.RecordBatch.from_arrays(
                        [index.column(0), pa.array([shard] * len(crc), pa.int32()), index.column(1),
                         index.column(2), pa.array(crc, pa.int64())],
                        [key, "shard", "start", "n_tokens", "ids_crc32"])

    return map_arrow(
        shards.repartition("shard"), run, f"`{key}` {kind}, shard int, start bigint, n_tokens bigint, ids_crc32 bigint")


def with_global_start(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """``start`` counted over all shards: shard totals (one row a shard) are summed in order."""
    totals = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("_total"))
    before = totals.select("shard", (F.sum("_total").over(Window.orderBy("shard")) - F.col("_total")).alias("_before"))
    return (rows.join(F.broadcast(before), "shard")      # one row a shard
            .withColumn("start", F.col("start") + F.col("_before")).drop("_before"))


def new_folder(spark: SparkSession) -> str:
    return shared_path(spark, "token-files")
