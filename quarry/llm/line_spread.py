"""Line dedup by distinct-site spread.

How many different sites carry a line is estimated by a HyperLogLog sketch per line hash; the
sketches are merged by aggregation, so a line on a third of all documents is a few kilobytes.
Lines whose estimate is near the threshold get an exact distinct count.  A line that at least
``min_sites`` sites carry is boilerplate: the document with the smallest id keeps it and all
others lose it, so nothing vanishes from the corpus.  Long lines, which no two sites write by
chance, may be given lower spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import packed, written

MIN_SITES = 10
MIN_WORDS = 3                            # shorter lines are headings and the like
LONG_LINES = ((12, 4), (50, 2))          # words from which on a line needs so many sites only
LG_K = 12                                # sketch registers: 2^12, 1.6 % standard error
NEAR = 0.1                               # estimates this close to the threshold are counted exactly


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def eligible(line: Column, min_words: int) -> Column:
    t = F.trim(line)
    return F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) >= min_words - 1


def sites_needed(line: Column, min_sites: int, min_words: int, long_lines: tuple[tuple[int, int], ...]) -> Column:
    """The sites that make a line boilerplate; null for a line that never goes."""
    need = F.when(eligible(line, min_words), F.lit(min_sites))
    for words, sites in sorted(long_lines):
        long = (F.length(line) >= 2 * words - 1) & (F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= words)
        need = F.when(long, F.least(need, F.lit(sites))).otherwise(need)
    return need


def spread_lines(docs: DataFrame, text: str, key: str, site: str, min_sites: int, min_words: int,
                 long_lines: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """``h, key`` of the rows that hold a line with at least as many rows as it needs sites (so all
    that can have so many), with its site and ``need``; written, since it is read three times."""
    lines = (docs.select(F.col(key).alias("key"), F.col(site).alias("site"),
                         F.explode(F.split(F.col(text), "\n")).alias("line"))
             .select("key", "site", line_hash(F.col("line")).alias("h"),
                     sites_needed(F.col("line"), min_sites, min_words, long_lines).alias("need"))
             .where(F.col("need").isNotNull()))
    many = (lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("least"))
            .where(F.col("n") >= F.col("least")).select("h"))
    return written(lines.join(many, "h", "left_semi"), "frequent-lines")


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """``h, keeper, n_sites`` of the lines on at least ``min_sites`` sites, or their ``need``."""
    need = F.min("need") if "need" in lines.columns else F.lit(min_sites)
    est = lines.groupBy("h").agg(
        F.round(F.hll_sketch_estimate(F.hll_sketch_agg(F.col("site").cast("string"), lg_k))).cast("long").alias("n_sites"),
        F.min("key").alias("keeper"), need.alias("need"))
    est = written(est, "line-spread")
    close = F.abs(F.col("n_sites") - F.col("need")) <= F.greatest(F.lit(1.0), F.round(F.col("need") * near))
    exact = (lines.join(est.where(close).select("h"), "h", "left_semi").select("h", "site").distinct()
             .groupBy("h").agg(F.count("site").alias("n_exact")))
    return (est.join(exact, "h", "left").withColumn("n_sites", F.coalesce("n_exact", "n_sites"))
            .where(F.col("n_sites") >= F.col("need")).select("h", "keeper", "n_sites"))


def remove_boilerplate(docs: DataFrame, text: str = "text", key: str = "doc_id", site: str = "source",
                       min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                       long_lines: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """``docs`` with ``text`` cleaned and the new columns ``n_lines`` and ``n_removed`` (which
    replace columns of those names); every row stays.

    Lines are parted at \\n and compared without outer spaces; those under ``min_words`` words
    never go, and those of so many words as ``long_lines`` lists need so many sites.  A null text
    stays null, an empty one empty.  A null site is no site; a row with a null key is counted but
    keeps its lines.  Repeated rows of a key are treated alike: all of the keeper's keep the line.
    Very long texts are read whole; an empty table gives no rows."""
    lines = spread_lines(docs, text, key, site, min_sites, min_words, long_lines)
    bad = boilerplate(lines, min_sites)
    gone = (lines.join(bad, "h").where(F.col("key") != F.col("keeper"))
            .groupBy("key").agg(F.collect_set("h").alias("gone")))
    rows = packed(docs).join(gone, F.col("row")[key] == F.col("key"), "left")
    parts = F.split(F.col("row")[text], "\n")
    kept = F.filter(parts, lambda x: ~(F.array_contains("gone", line_hash(x))
                                         & sites_needed(x, min_sites, min_words, long_lines).isNotNull()))
    zero = F.lit(0).cast("long")
    touched = F.col("kept").isNotNull()
    rows = (rows.withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
            .withColumn("n_lines", F.when(F.col("row")[text].isNull(), zero).otherwise(F.size(parts).cast("long")))
            .withColumn("n_removed", F.when(touched, F.col("n_lines") - F.size("kept")).otherwise(zero))
            .withColumn("clean", F.when(touched, F.array_join("kept", "\n")).otherwise(F.col("row")[text])))
    cols = [F.col("clean").alias(c) if c == text else F.col("row")[c].alias(c)
            for c in docs.columns if c not in ("n_lines", "n_removed")]
    return rows.select(*cols, "n_lines", "n_removed")
