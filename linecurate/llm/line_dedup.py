"""Cross-site boilerplate lines by distinct-site spread (DataFrame functions only).

Sites are counted by one HyperLogLog sketch a line hash, merged by aggregation. Lines whose
estimate is near the threshold get an exact distinct count before anything is removed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import cut

BLANKS = " \t\r"
MIN_SITES = 10
LG_K = 12


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(docs: DataFrame, site: str) -> DataFrame:
    """A row for each line: the document's key, position, two hashes of the trimmed line, site."""
    rows = docs.select(
        F.col("doc_id").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), F.col(site).alias("site"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(BLANKS))
    return rows.select("d", "t", "site", "pos", F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"), (line == "").alias("blank"))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of every non-blank line that occurs in at least min_sites distinct sites.

    `first` is the line's occurrence with the smallest (doc_id, text hash, position). Null sites
    count as none. The result is checkpointed.
    """
    slack = max(1, math.ceil(3 * 1.04 / math.sqrt(2**lg_k) * min_sites))
    lines = _keyed(docs, site).where(~F.col("blank"))
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.count("site").alias("n"), F.min(F.struct("d", "t", "pos")).alias("first")
    )
    spread = spread.where(F.col("n") >= min_sites).withColumn("sites", F.hll_sketch_estimate("sketch"))
    likely = cut(spread.where(F.col("sites") >= min_sites - slack).select("h1", "h2", "first", "sites"))
    sure = likely.where(F.col("sites") > min_sites + slack)
    near = likely.where(F.col("sites") <= min_sites + slack)
    counted = (
        lines.where(F.col("site").isNotNull()).join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("*").alias("exact"))
    )
    proven = near.join(counted.where(F.col("exact") >= min_sites).select("h1", "h2"), ["h1", "h2"], "left_semi")
    return cut(sure.union(proven).select("h1", "h2", "first"))


def drop_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """docs with every boilerplate line removed from `text`, but for its first occurrence.

    Lines are the pieces between line feeds, compared after trimming blanks, tabs and carriage
    returns; blank lines always stay. Returns all columns of docs (other columns, whatever their
    names, pass through) and two more, `lines_seen` and `lines_dropped`. A null text stays null
    and has no line; texts without a dropped line come back byte for byte. Rows that repeat a
    doc_id with the same text are treated alike; null doc_ids are allowed and come first.
    """
    keyed = _keyed(docs, site)
    marked = (
        keyed.join(boilerplate(docs, site, min_sites, lg_k), ["h1", "h2"], "left")
        .select("d", "t", "pos", (F.col("first").isNotNull() & ~F.col("blank") & ~F.col("first").eqNullSafe(F.struct("d", "t", "pos"))).alias("drop"))
    )
    flags = marked.groupBy("d", "t").agg(F.collect_set(F.struct("pos", "drop")).alias("marks"), F.max("drop").alias("any")).where("any")
    flags = flags.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.transform(F.array_sort("marks"), lambda m: m["drop"]).alias("__flags"))
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(flags, docs["doc_id"].eqNullSafe(F.col("__d")) & (own == F.col("__t")), "left")
    kept = F.array_join(F.filter(_lines(docs["text"]), lambda x, i: ~F.get(F.col("__flags"), i)), "\n")
    columns = [F.when(F.col("__flags").isNull(), docs["text"]).otherwise(kept).alias("text") if c == "text" else docs[f"`{c}`"] for c in docs.columns]
    return joined.select(
        *columns,
        F.when(docs["text"].isNull(), 0).otherwise(F.size(_lines(docs["text"]))).cast("long").alias("lines_seen"),
        F.coalesce(F.size(F.filter("__flags", lambda x: x)), F.lit(0)).cast("long").alias("lines_dropped"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """`documents` without the lines that ten or more sources share (first occurrences stay)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return drop_boilerplate(docs).select("doc_id", "lines_seen", "lines_dropped", "text")


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos, text IS NULL AS missing
  FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
wide AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS rn FROM keyed),
marked AS (SELECT r.*, (w.k IS NOT NULL AND r.rn > 1) AS dropped FROM ranked r LEFT JOIN wide w ON r.k = w.k)
SELECT doc_id, sum(CASE WHEN missing THEN 0 ELSE 1 END)::BIGINT AS lines_seen,
       sum(CASE WHEN dropped THEN 1 ELSE 0 END)::BIGINT AS lines_dropped,
       CASE WHEN bool_or(missing) THEN NULL
            ELSE coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') END AS text
FROM marked GROUP BY doc_id
"""
