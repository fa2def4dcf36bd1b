"""Skew-safe ordered scans.

Any group (a run, a user, a file) may hold a third of all rows, so nothing here puts a whole
group into one task, as a window ``partitionBy(group)`` would.  Instead:

* ``dense_index`` numbers rows inside each group in a given order.  It range-partitions on
  (group, order), which cuts a hot group into many partitions, tags each row with its
  partition and position, writes them (so the tags are stable and survive executor loss),
  and adds to each row the count of its group's rows in earlier partitions.  Only one
  small table (one row per partition and group) is windowed.
* ``global_index`` does the same for a whole frame, on its distinct keys alone; the rows of a repeated
  key share the range that their count takes.
* ``prefix_scan`` computes running min / max / sum / count / last over a dense index: one summary
  row per (group, chunk of ``chunk`` rows), a running carry over the summaries in two levels
  (chunks within a block of chunks, then blocks), and a local running value inside each chunk.
  Work per task is bounded by the chunk and block sizes.
* ``top_k_per_group`` keeps the k first rows per group in two bounded steps (per salt bucket,
  then per group), never sorting a whole group in one task.
* ``shift_by_index`` is ``lag``/``lead`` as an equi-join on (group, index ± n).

Group keys travel as one struct, so groups with null keys are groups like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

DEFAULT_CHUNK = 4096
DEFAULT_BLOCK = 4096          # chunks of a block
DEFAULT_SALT = 16


def _target_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def group_key(keys: Sequence[str]) -> Column:
    """The group as one never-null struct (a constant for no keys)."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _tagged(df: DataFrame, sort_cols: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Rows in range partitions of ``sort_cols``, with partition and position, written."""
    n = num_partitions or _target_partitions(df)
    return cut_lineage(df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()), "ordered")


def dense_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order) - 1`` without a per-group task.

    ``order`` must make rows unique inside a group (add a tie-breaking id)."""
    keys = list(keys)
    tagged = _tagged(df, [F.col(k) for k in keys] + _columns(order), num_partitions).withColumn("_key", group_key(keys))
    summary = (tagged.groupBy("_pid", "_key")
                     .agg(F.min("_pos").alias("_p0"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = tagged.join(summary.select("_key", "_pid", "_p0", "_base"), ["_pid", "_key"])
    return cut_lineage(joined.withColumn(out, (F.col("_base") + F.col("_pos") - F.col("_p0")).cast("long"))
                       .drop("_pid", "_pos", "_p0", "_base", "_key"), "indexed")


def global_index(df: DataFrame, order: Sequence[str | Column], out: str = "idx",
                 num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """A dense 0-based index over the whole frame in ``order``, and the row count.

    Only the order columns are counted, sorted and written, never the rest of a row; the distinct
    keys' places meet the rows in one join, so a caller that needs no text moves none.  Rows
    with equal order columns share a range of the index and get its numbers in no certain order,
    each its own: ``dense_index`` deals them out, so that a key may hold any share of the rows."""
    cols = _columns(order)
    named = [c.alias(f"_o{i}") for i, c in enumerate(cols)]
    names = [f"_o{i}" for i in range(len(cols))]
    keys = df.select(*named).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    tagged = _tagged(keys, [F.col(n) for n in names], num_partitions)
    per = tagged.groupBy("_pid").agg(F.sum("_n").alias("_rows"), F.min("_pos").alias("_p0"), F.max("_n").alias("_most"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)        # one row a partition
    per = per.withColumn("_base", F.coalesce(F.sum("_rows").over(w), F.lit(0)))
    total, most = per.agg(F.sum("_rows"), F.max("_most")).first()
    place = tagged.join(F.broadcast(per.select("_pid", "_p0", "_base")), "_pid")
    if (most or 0) <= 1:
        start = F.col("_base") + F.col("_pos") - F.col("_p0")
    else:
        earlier = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("_base") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    index = place.select(F.struct(*names).alias("_order"), start.cast("long").alias("_start"), "_n")
    rows = df.withColumn("_order", F.struct(*named)).join(index, "_order")
    single = rows.where("_n = 1") if (most or 0) > 1 else rows
    single = single.withColumn(out, F.col("_start")).drop("_order", "_start", "_n")
    if (most or 0) <= 1:
        return single, int(total or 0)
    # Random numbers cut a hot key's rows into many range partitions; they are fixed once written.
    several = dense_index(rows.where("_n > 1").withColumn("_salt", F.rand(0)), ["_order"], ["_salt"], "_number", num_partitions)
    several = several.withColumn(out, F.col("_start") + F.col("_number")).drop("_order", "_start", "_n", "_salt", "_number")
    return single.unionByName(several), int(total or 0)


_RUNNING = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum, "last": F.last}


def _merge(fn: str, before: Column, here: Column) -> Column:
    """What ``fn`` gives over two frames in a row, of which either may be empty (null)."""
    if fn == "min":
        return F.least(before, here)
    if fn == "max":
        return F.greatest(before, here)
    if fn == "last":
        return F.coalesce(here, before)
    both = F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
    return both.cast("long") if fn == "count" else F.when(before.isNotNull() | here.isNotNull(), both)


def prefix_scan(df: DataFrame, keys: Sequence[str], idx: str,
                specs: Sequence[tuple[str, str, str | Column, bool]],
                chunk: int = DEFAULT_CHUNK, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Running aggregates inside each group in ``idx`` order.

    ``specs``: (out column, fn in min/max/sum/count/last, value column, inclusive).  Inclusive
    means rows up to and including the current one (``rowsBetween(unboundedPreceding, 0)``),
    exclusive means strictly before it (``..., -1``).  Null values are skipped as in SQL, but by
    ``last``, whose exclusive form is ``lag``; an empty frame gives null, and 0 for count."""
    fns = [fn for _, fn, _, _ in specs]
    d = df.withColumn("_key", group_key(keys)).withColumn("_chunk", F.floor(F.col(idx) / F.lit(chunk)))
    for i, (_, fn, value, _) in enumerate(specs):
        v = F.col(value) if isinstance(value, str) else value
        d = d.withColumn(f"_v{i}", F.struct(v.alias("v")) if fn == "last" else v.isNotNull().cast("long") if fn == "count" else v)
    part = lambda fn, c, by: (F.max_by(c, by) if fn == "last" else _RUNNING[fn](c))
    chunks = d.groupBy("_key", "_chunk").agg(*[part(fn, F.col(f"_v{i}"), F.col(idx)).alias(f"_s{i}") for i, fn in enumerate(fns)])
    chunks = chunks.withColumn("_block", F.floor(F.col("_chunk") / F.lit(block)))
    blocks = chunks.groupBy("_key", "_block").agg(*[part(fn, F.col(f"_s{i}"), F.col("_chunk")).alias(f"_t{i}") for i, fn in enumerate(fns)])
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    w = earlier("_key", "_block")
    blocks = blocks.select("_key", "_block", *[_RUNNING[fn](F.col(f"_t{i}")).over(w).alias(f"_u{i}") for i, fn in enumerate(fns)])
    w = earlier("_key", "_block", "_chunk")
    carry = chunks.select("_key", "_block", "_chunk", *[_RUNNING[fn](F.col(f"_s{i}")).over(w).alias(f"_c{i}") for i, fn in enumerate(fns)])
    carry = carry.join(blocks, ["_key", "_block"]).select(
        "_key", "_chunk", *[_merge(fn, F.col(f"_u{i}"), F.col(f"_c{i}")).alias(f"_carry{i}") for i, fn in enumerate(fns)])
    carry = cut_lineage(carry, "carry")          # one row a chunk: the rows' plan is one window and one join
    local = Window.partitionBy("_key", "_chunk").orderBy(idx)
    for i, (_, fn, _, inclusive) in enumerate(specs):
        frame = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        d = d.withColumn(f"_loc{i}", _RUNNING[fn](F.col(f"_v{i}")).over(frame))
    # the join on (key, chunk) reuses the window's hash partitioning: no exchange of the rows
    j = d.join(carry, ["_key", "_chunk"])
    for i, (out, fn, _, _) in enumerate(specs):
        v = _merge(fn, F.col(f"_carry{i}"), F.col(f"_loc{i}"))
        j = j.withColumn(out, v["v"] if fn == "last" else v)
    return j.drop("_key", "_chunk", *[f"_{x}{i}" for i in range(len(specs)) for x in ("v", "loc", "carry")])


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    salt_col: str | Column | None = None, buckets: int = DEFAULT_SALT,
                    rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group under ``order`` (unique inside a group).

    Step 1 keeps the top k per (group, salt bucket); step 2 ranks those ≤ k·buckets rows per
    group.  ``rank_col`` (1-based) is added when given."""
    keys = list(keys)
    salt = (F.col(salt_col) if isinstance(salt_col, str) else salt_col) if salt_col is not None \
        else F.monotonically_increasing_id()
    d = df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    d = d.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    d = d.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= k)
    if rank_col:
        d = d.withColumn(rank_col, F.col("_r2").cast("long"))
    return d.drop("_salt", "_r1", "_r2")


def shift_by_index(df: DataFrame, keys: Sequence[str], idx: str, cols: Sequence[str],
                   offset: int = 1, prefix: str = "prev_") -> DataFrame:
    """``lag(col, offset)`` over a dense index, as a left equi-join on (keys, idx - offset)."""
    d = df.withColumn("_key", group_key(keys))
    other = d.select("_key", (F.col(idx) + F.lit(offset)).alias(idx), *[F.col(c).alias(prefix + c) for c in cols])
    return d.join(other, ["_key", idx], "left").drop("_key")
