"""Writers. Spark's committer makes them atomic: readers never see half a result."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _mode(force: bool) -> str:
    return "overwrite" if force else "errorifexists"


def write_report(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str | Column] = (), delimiter: str = ";", force: bool = False) -> None:
    """CSV with a header and these columns, in as many files as df has partitions, sorted if ordered."""
    out = df.orderBy(*order) if order else df
    out.select(*columns).write.mode(_mode(force)).csv(path, sep=delimiter, header=True, quote='"', escape='"', emptyValue="")


def write_jsonl(df: DataFrame, path: str, columns: Sequence[str], force: bool = False) -> None:
    """One object a line, keys in this order, null fields left out, letters as they are."""
    df.select(F.to_json(F.struct(*columns)).alias("value")).write.mode(_mode(force)).text(path)


def summary(df: DataFrame, measures: Mapping[str, Column]) -> str:
    """JSON text of one row of aggregates; nulls stay, as null."""
    return df.agg(*[c.alias(k) for k, c in measures.items()]).select(F.to_json(F.struct(*measures), {"ignoreNullFields": "false"})).first()[0]


def fan_out(df: DataFrame, sinks: Mapping[str, tuple[Column | None, Sequence[str]]], base: str, force: bool = False) -> None:
    """Several reports (name: condition and columns) of one cached set of rows."""
    held = df.persist()
    try:
        for name, (condition, columns) in sinks.items():
            write_report(held if condition is None else held.where(condition), f"{base}/{name}", columns, force=force)
    finally:
        held.unpersist()


def playlists(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """(group, playlist): the group's file names in order, one a line."""
    rows = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, name))).alias("r"))
    return rows.select(group, F.concat(F.lit("#EXTM3U\n"), F.array_join(F.transform("r", lambda x: x[name]), "\n")).alias("playlist"))


def routes(df: DataFrame, action: Column, folders: Mapping[str, str], name: Column) -> DataFrame:
    """Adds `target` by action, null for an unknown one (a violation to be checked)."""
    out = None
    for a, folder in folders.items():
        out = F.when(action == a, F.concat(F.lit(folder + "/"), name)) if out is None else out.when(action == a, F.concat(F.lit(folder + "/"), name))
    return df.withColumn("target", out)


def references_toml(rows: Sequence[Mapping[str, object]], default: str) -> str:
    """TOML text of reference styles, as read_references reads it."""
    quote = lambda v: str(v).lower() if isinstance(v, bool) else '"' + str(v).replace("\\", "\\\\").replace('"', '\\"') + '"'
    parts = [f"[estilos]\npadrao = {quote(default)}\n"]
    for r in rows:
        parts.append(f"[referencias.{r['style']}]\n" + "".join(f"{k} = {quote(v)}\n" for k, v in r.items() if k != "style" and v is not None))
    return "\n".join(parts)


def write_bytes(spark: SparkSession, path: str, data: bytes, force: bool = False) -> None:
    """One file of bytes on whatever file system path names, written aside and then renamed; fails if it is there, but with force."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    partial = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".partial")
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(where) and not force:
        raise FileExistsError(path)
    out = system.create(partial, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    system.delete(where, False)
    system.rename(partial, where)


def write_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """Writes each row's bytes as a file of its own, where the row is, aside and then renamed; returns how many. Names are unique."""
    from .archive_source import file_system

    def run(batches):
        import pyarrow as pa

        system, inner = file_system(folder)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                aside = f"{inner}/.{file.as_py()}.{uuid.uuid4().hex}"
                with system.open_output_stream(aside) as out:
                    out.write(data.as_py())
                system.move(aside, f"{inner}/{file.as_py()}")
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["n"])

    return df.select(name, content).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
