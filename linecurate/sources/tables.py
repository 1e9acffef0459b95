"""Delimited, JSON and listing sources."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import given, normalize_id, parse_ident
from .reports import lines_in_blocks, read_in_blocks


def spread(df: DataFrame) -> DataFrame:
    """df dealt out over all cores if it comes in fewer partitions than there are cores (one small
    file, say), for work that costs more than moving the rows; a larger input isn't moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def numbered_lines(spark: SparkSession, path: str, joined: bool = False) -> DataFrame:
    """(line_no, line) of text files of any size; numbers start at 1 in each file, or go on from file to file, in order of Spark's part names, if joined.

    Files are read in blocks, and lines aren't shuffled. A line's number is its place in its block
    and the lines of the blocks before it, of which there is one row each.
    """
    rows = lines_in_blocks(spark, path)
    sizes = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # part numbers of more than five digits make longer names
    order = Window.orderBy(F.char_length("file"), "file", "block") if joined else Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(F.broadcast(sizes.select("file", "block", "first", before.alias("before"))), ["file", "block"])
    return placed.select((F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), F.when(F.startswith("value", F.lit("\ufeff")), F.substr("value", F.lit(2))).otherwise(F.col("value")).alias("line"))


def read_lines(spark: SparkSession, path: str, need_text: bool = True, joined: bool = False, wide: bool = False) -> DataFrame:
    """(ident, text, line_no) of a pipe-delimited corpus: decimal id first, text last; blank lines,
    ; comments and rows without an id or a second column are skipped, and without a text if need_text.
    If joined, the files of a folder are numbered as one. Ids have 32 bits, or 64 with a sign if wide."""
    lines = numbered_lines(spark, path, joined).where(~F.trim("line").startswith(";") & (F.trim("line") != ""))
    if wide:
        ident = lambda p: F.when(F.trim(p[0]).rlike("^-?[0-9]+$"), F.trim(p[0])).try_cast("long")
    else:
        ident = lambda p: parse_ident(F.when(F.trim(p[0]).rlike("^[0-9]+$"), p[0]))
    cells = given(F.split("line", "[|]"), lambda p: F.struct(ident(p).alias("ident"), F.trim(F.element_at(p, -1)).alias("text"), F.size(p).alias("cells")))
    # by inline, so that a line is cut once and not again for each condition
    out = lines.select("line_no", F.inline(F.array(cells))).where("cells >= 2").select("ident", "text", "line_no")
    return out.where("ident is not null and text <> ''" if need_text else "ident is not null")


def read_report(spark: SparkSession, path: str, schema: str | T.StructType, delimiter: str = ";", header: bool = True) -> DataFrame:
    """CSV with a header, doubled quotes and line feeds in cells; empty cells are empty texts. A
    missing column fails; those that the schema doesn't name are left out. Files are read in blocks."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    texts = read_in_blocks(spark, path, delimiter, header)
    if not header:
        texts = texts.toDF(*[f.name for f in schema.fields][: len(texts.columns)])
    absent = [f.name for f in schema.fields if f.name not in texts.columns]
    if absent:
        raise ValueError(f"{path}: columns missing: {', '.join(absent)}")
    return texts.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_jsonl(spark: SparkSession, path: str, schema: str, keep_raw: bool = True) -> DataFrame:
    """One object a line, blank lines skipped; a line that doesn't parse fails the job. `raw` has the
    whole object, so that keys outside the schema aren't lost."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    out = rows.select("value", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j"))
    return out.select("j.*", *([F.col("value").alias("raw")] if keep_raw else []))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, line_no), one a line, # comments; ids in canonical form, null where they aren't one."""
    rows = numbered_lines(spark, path).withColumn("t", F.trim(F.element_at(F.split("line", "#"), 1))).where("t <> ''")
    return rows.select(normalize_id("t").alias("id"), "line_no")


def read_assignments(spark: SparkSession, path: str, default: str = "sem_estilo") -> DataFrame:
    """(id, style) by position; a first row of names is skipped, a blank style is the default, and of an id that repeats the last row counts."""
    t = read_in_blocks(spark, path, header=False, place="__place")
    t = t.toDF("id", "style", *t.columns[2:]).where(~F.lower(F.trim("id")).isin("id", "id_hex"))
    rows = t.select(normalize_id("id").alias("id"), F.coalesce(F.nullif(F.trim("style"), F.lit("")), F.lit(default)).alias("style"), "__place")
    return rows.groupBy("id").agg(F.max_by("style", "__place").alias("style"))


def list_files(spark: SparkSession, path: str, pattern: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, length, and the pattern's groups as g1, g2, ...) of files whose name matches; contents aren't read, and Spark's source leaves out empty files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length")
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).where(F.col("name").rlike(pattern))
    groups = pattern.replace("(?:", "").replace("(?!", "").replace(r"\(", "").count("(")
    return named.withColumns({f"g{i}": F.regexp_extract("name", pattern, i) for i in range(1, groups + 1)})


VARIANT_NAME = r"^(0x[0-9a-f]{8})__(.+?)(?:_(falha|melhor|tempo))?\.wav$"


def package_order(listing: DataFrame, name: str = "name", natural: bool = True) -> DataFrame:
    """Keeps content*, bob, ep1, dlc* packages and adds source_index: base first, numbers as numbers if natural."""
    base = listing.where(F.col(name).rlike(r"^(?:content\d*|bob|ep1|dlc\d+)$"))
    group = F.when(F.col(name).startswith("content"), 0).otherwise(1)
    number = F.coalesce(F.regexp_extract(name, r"(\d+)$", 1).try_cast("int"), F.lit(-1))
    order = [group, F.regexp_replace(name, r"\d+$", ""), number] if natural else [group, F.col(name)]
    return base.withColumn("source_index", F.row_number().over(Window.orderBy(*order)) - 1)


def read_references(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """(style, enabled, ref_audio, ref_text_file, prompt) of a TOML file, and the default style,
    which must exist and be enabled. Configuration of a page or so, read by Spark and parsed on the driver."""
    config = tomllib.loads(spark.read.text(path, wholetext=True).first()[0])
    default = config["estilos"]["padrao"]
    table = config["referencias"]
    if not table.get(default, {}).get("enabled", False):
        raise ValueError(f"default style {default!r} is missing or not enabled")
    rows = [(k, bool(v.get("enabled", False)), v.get("ref_audio"), v.get("ref_text_file"), v.get("prompt")) for k, v in table.items()]
    return spark.createDataFrame(rows, "style string, enabled boolean, ref_audio string, ref_text_file string, prompt string"), default
