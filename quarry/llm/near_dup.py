"""MinHash near-duplicates with ProbMinHash: signatures, banding, verification, classes.

1. A map-side pass sketches every text: digest, band buckets, signature.  A text that repeats a
   shingle has a second signature with unit weights, for the Jaccard, and its buckets too; in
   others the two are one.
2. Equal texts are one node at once, known by a digest of the text and not by an id, so rows of one
   id with different texts are different nodes; one row represents a node from here on.
3. In each bucket every representative is paired with the bucket's centre only - the member whose
   buckets are the fullest, which in a group of near copies is the one most others are close to -
   and the pairs are verified exactly on their shingles.  Links give components.
4. A bucket whose members are still in several components may hide a link between two members
   of which neither is its centre.  There, the members outside the bucket's largest component are
   compared with all others of the bucket, block by block: pairs of different components whose
   signatures could reach the threshold are verified exactly in the task, which unites what it
   links and so emits at most one link for each union, never the pairs of a group.
5. Components of all verified links are the classes of texts; where classes of ids are asked for,
   the texts of one id are linked too.

Shingles are compared by 32 bits of their hashes: two texts of 20,000 words share one by chance
once in ten times.  No bucket is gathered in one task, and nothing but counters reaches the
driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import probminhash as pm
from quarry.llm.common import fresh, list_array, map_arrow, slices, texts, written
from quarry.llm.components import components

THRESHOLD = 0.8
MARGIN = 0.12                # four standard errors of the signature's estimate near the threshold
BLOCK = 512                  # members of a block in step 4


def sketches(docs: DataFrame, text: str, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, digest, n, bands, sig`` and the columns ``keep`` per row with an id; ``n`` is the number of shingles, ``sig`` the
    weighted signature, then the unit one if it differs, and ``bands`` the buckets of either."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in slices(batches, "_text"):
            t = texts(b.column("_text"))
            sets = [pm.shingles(x) for x in t]
            sig = pm.signatures(sets)
            digest = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in t]
            again = [i for i, (_, c) in enumerate(sets) if (c > 1).any()]
            unit = sig.copy()
            unit[again] = pm.signatures([(sets[i][0], np.ones_like(sets[i][1])) for i in again])
            bands = np.hstack([pm.band_hashes(sig), pm.band_hashes(unit)])
            two = np.zeros(len(t), bool)
            two[again] = True
            use = np.hstack([np.ones((len(t), pm.BANDS), bool), np.repeat(two[:, None], pm.BANDS, 1)])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(digest, pa.binary()), pa.array([len(k) for k, _ in sets], pa.int64()),
                 list_array(use.sum(1), pa.array(bands[use])),
                 pa.array([s.tobytes() + (u.tobytes() if x else b"") for s, u, x in zip(sig, unit, two)], pa.binary()),
                 *(b.column(c) for c in keep)], ["id", "digest", "n", "bands", "sig", *keep])

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("string").alias("_text"), *keep)
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(
        rows.select("_text", "id", *keep), run, f"id {kind}, digest binary, n bigint, bands array<bigint>, sig binary{more}")


def _set(text: str) -> tuple[bytes, bytes]:
    """Sorted 32-bit shingle hashes of a text, and their counts unless all are one, as in most texts."""
    k, c = pm.shingles(text)
    k, at = np.unique((k >> np.uint64(32)).astype("<u4"), return_inverse=True)
    c = np.bincount(at, c, len(k)).astype("<u4")
    return k.tobytes(), c.tobytes() if (c > 1).any() else b""


def _unpack(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(hashes, "<u4")
    return k, np.frombuffer(counts, "<u4") if counts else np.ones(len(k), "<u4")


def shingle_rows(docs: DataFrame, ids: DataFrame, text: str, key: str, also: tuple[str, ...] = ()) -> DataFrame:
    """``id, hashes, counts`` of the documents in ``ids`` (by ``id`` and the columns ``also``), for exact
    similarities."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in slices(batches, "_text"):
            sets = [_set(x) for x in texts(b.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(x, pa.binary()) for x in (zip(*sets) if sets else ((), ())))], ["id", "hashes", "counts"])

    # Candidates grow with the corpus: a plan that broadcasts them at a small size is no plan.
    rows = docs.select(F.col(text).cast("string").alias("_text"), F.col(key).alias("id"), *also)
    rows = rows.join(ids.hint("merge"), ["id", *also], "left_semi")
    return map_arrow(rows.select("_text", "id"), run, f"id {kind}, hashes binary, counts binary").dropDuplicates(["id"])


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose Jaccard or probability Jaccard is at least ``threshold``, written."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("hashes").alias(f"h{x}"), F.col("counts").alias(f"c{x}"))
    kind = sets.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                b = batch.slice(start, 256)
                ha, ca, hb, cb = (b.column(c).to_pylist() for c in ("ha", "ca", "hb", "cb"))
                ok = [max(pm.similarity(_unpack(p, q), _unpack(r, s))) >= threshold
                      for p, q, r, s in zip(ha, ca, hb, cb)]
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ha", "ca", "hb", "cb")
    return written(map_arrow(both, run, f"a {kind}, b {kind}"), "links")


def open_links(members: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links ``a > b`` that unite components which share a bucket; ``members``: ``bucket, band, id, comp``."""
    size = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    top = size.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("n", "comp")).alias("t"),
                                     F.sum("n").alias("all")).where("k > 1")
    open_ = (members.join(top.select("bucket", F.col("t.comp").alias("big"), F.col("t.n").alias("n_big"), "all"), "bucket")
             .withColumn("few", F.col("all") - F.col("n_big")))
    open_ = written(open_, "open-buckets")
    own = written(sets.join(open_.select("id").distinct().hint("merge"), "id", "left_semi").join(sigs, "id"), "open-sets")
    open_ = open_.join(own, "id")
    cut = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    part = lambda n: F.pmod(F.xxhash64("id"), cut(F.col(n))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), cut(F.col(n)) - 1))
    cols = ("bucket", "x", "y", "id", "comp", "sig", "hashes", "counts")
    few = open_.where("comp <> big").withColumn("x", part("few")).withColumn("y", every("all")).select(*cols, "band", "big")
    all_ = (open_.withColumn("y", part("all")).withColumn("x", every("few")).select(*cols).toDF(*[f"{c}2" for c in cols]))
    need = int(np.ceil((threshold - MARGIN) * pm.REGISTERS))
    kind = members.schema["id"].dataType.simpleString()

    def run(f: pa.Table, g: pa.Table) -> pa.Table:
        a, b = [], []
        if f.num_rows and g.num_rows:
            (fi, fc, fs, fsets), (gi, gc, gs, gsets) = map(_side, (f, g))
            band, big = f.column(8)[0].as_py(), f.column(9)[0].as_py()
            up: dict = {}

            def top(c):
                while c in up:
                    c = up[c]
                return c

            for i in range(len(fi)):
                # Registers of either kind: both weighted, both unit, and, as they share buckets, crossed.
                eqs = [gs[:, y] == fs[i, x] for x, y in _kinds(fs[i], gs)]
                same = np.max([e.sum(1) for e in eqs], 0)
                # Of the buckets that two texts share, those of the first band compare them.
                first = np.any([e.reshape(len(gs), pm.BANDS, pm.ROWS).all(2) for e in eqs], 0).argmax(1) == band
                hit = np.flatnonzero((same >= need) & first)
                for j in hit[np.argsort(-same[hit], kind="stable")]:
                    c, d = top(fc[i]), top(gc[j])
                    # Two members outside the largest component meet twice; one meeting is enough.
                    if c == d or gc[j] != big and fi[i] < gi[j]:
                        continue
                    if max(pm.similarity(fsets[i], gsets[j])) >= threshold:
                        up[c] = d
                        a.append(max(fi[i], gi[j]))
                        b.append(min(fi[i], gi[j]))
        t = f.schema.field(3).type
        return pa.table({"a": pa.array(a, t), "b": pa.array(b, t)})

    keys = ("bucket", "x", "y")
    found = few.groupBy(*keys).cogroup(all_.groupBy(*[f"{k}2" for k in keys])).applyInArrow(run, f"a {kind}, b {kind}")
    return written(found.distinct(), "open-links")


def _kinds(one: np.ndarray, others: np.ndarray) -> tuple[tuple[int, int], ...]:
    """Which signatures to compare: one pair if weighted and unit ones are the same on both sides."""
    if (one[0] == one[1]).all() and (others[:, 0] == others[:, 1]).all():
        return ((0, 0),)
    return ((0, 0), (1, 1), (0, 1), (1, 0))


def _side(t: pa.Table):
    """Ids, components, signatures (weighted and unit) and shingle sets of a block."""
    ids, comps, sig, hashes, counts = (t.column(i).to_pylist() for i in range(3, 8))
    size = pm.REGISTERS * pm.SIG_TYPE.itemsize
    sigs = np.frombuffer(b"".join(s if len(s) > size else s + s for s in sig), pm.SIG_TYPE).reshape(len(ids), 2, -1)
    return ids, comps, sigs, [_unpack(h, c) for h, c in zip(hashes, counts)]


def with_components(rows: DataFrame, links: DataFrame) -> DataFrame:
    c = components(links, "a", "b")
    return (rows.join(c.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("comp", F.coalesce("label", "id")).drop("label"))


def text_digest(text: str) -> Column:
    """What a text is known by; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def text_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Rows ``_id, id, n`` of every row with a key (``id`` is its text's digest, ``n`` its shingles), and the
    ``node, label`` of all texts that are linked to another: texts of one label are one class."""
    docs = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    docs = docs.where(F.col("_id").isNotNull()).withColumn("_node", text_digest("_text"))
    sk = written(sketches(docs, "_text", "_node", ("_id",)), "sketches")
    some = sk.where("n > 0")
    rep = some.groupBy("id").agg(F.min("_id").alias("_id"))
    own = some.join(rep.hint("merge"), ["id", "_id"], "left_semi")
    member = own.select("id", "_id", F.posexplode("bands").alias("band", "bucket"))
    member = member.withColumn("band", F.col("band") % pm.BANDS).distinct()
    size = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(member.join(size, "bucket"), "buckets")
    fullness = shared.groupBy("id").agg(F.sum("n").alias("full"))
    centre = (shared.join(fullness, "id").groupBy("bucket")
              .agg(F.max_by("id", F.struct("full", F.xxhash64("id"))).alias("c")))
    star = (shared.join(centre, "bucket").where("id <> c")
            .select(F.greatest("id", "c").alias("a"), F.least("id", "c").alias("b")).distinct())
    sets = written(shingle_rows(docs, shared.select("id", "_id").distinct(), "_text", "_node", ("_id",)), "shingles")
    links = verify(star, sets, threshold)
    sigs = own.select("id", "sig").dropDuplicates(["id"])
    links = links.unionByName(open_links(with_components(shared.select("bucket", "band", "id"), links), sigs, sets, threshold))
    return sk.select("_id", "id", "n"), components(links, "a", "b")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key, class_id, n_shingles`` per row with an id: documents of one class are linked by exact
    copies or by similarities of at least ``threshold``; ``class_id`` is the smallest id.

    Shingles are five words; a shorter text is one shingle, a null or empty text has none and is
    a class of its own.  Repeated rows of an id share its class; rows of one id with different
    texts are linked through each, and ``n_shingles`` is their largest.  A null id has no class (its rows
    come out with null).  Very long texts are sketched whole; an empty table gives no rows; other
    columns are left behind."""
    docs = docs.select(key, text)
    rows, label = text_classes(docs, text, key, threshold)
    rows = rows.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("label", "id"))
    some = rows.where("n > 0")
    several = some.groupBy("_id").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    same_id = components(some.join(several, "_id").where("comp <> low").select(F.col("comp").alias("a"), F.col("low").alias("b")), "a", "b")
    some = (some.join(same_id.select(F.col("node").alias("comp"), F.col("label").alias("one")), "comp", "left")
            .withColumn("comp", F.coalesce("one", "comp")))
    least = some.groupBy("comp").agg(F.min("_id").alias("class_id"))
    known = some.select("_id", "comp").distinct().join(least, "comp").groupBy("_id").agg(F.min("class_id").alias("class_id"))
    known = rows.groupBy("_id").agg(F.max("n").alias("n_shingles")).join(known, "_id", "left")
    known = known.select("_id", F.coalesce("class_id", "_id").alias("class_id"), "n_shingles")
    return docs.select(key).join(known, F.col(key) == F.col("_id"), "left").drop("_id")


def one_of_each_class(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class of texts the row with the smallest id,
    once.  Rows of one id with unrelated texts stay, each text once; so do rows without an id, as they
    are.  Texts without words stay once an id.  All columns are kept."""
    rows, label = text_classes(docs, text, key, threshold)
    some = rows.where("n > 0").join(label.withColumnRenamed("node", "id"), "id", "left")
    first = some.groupBy(F.coalesce("label", "id").alias("comp")).agg(F.min(F.struct("_id", "id")).alias("k")).select("k.*")
    keep = first.unionByName(rows.where("n = 0").select("_id", "id").distinct())
    at = fresh(docs, "digest")
    one = docs.withColumn(at, text_digest(text))
    same = (one[key] == keep["_id"]) & (one[at] == keep["id"])
    one = one.join(keep.hint("merge"), same, "left_semi").dropDuplicates([key, at]).drop(at)
    return one.unionByName(docs.where(F.col(key).isNull()))
