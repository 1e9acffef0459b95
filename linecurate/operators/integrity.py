"""Keys, duplicates, conflicts and coverage; each check gives the offending rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .idsets import memberships


class IntegrityError(ValueError):
    """A check that must pass found rows; the message has the first of them."""


def require_none(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raises with the first violations, if there are any."""
    rows = violations.take(show)
    if rows:
        raise IntegrityError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("__b"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in rest])


def dedup_with_provenance(df: DataFrame, key: str, value: str, line: str) -> DataFrame:
    """(key, value, lines, rows, conflict): the smallest value, the sorted line numbers, and whether values differ."""
    return df.groupBy(key).agg(
        F.min(value).alias(value), F.array_sort(F.collect_list(line)).alias("lines"), F.count("*").alias("rows"), (F.min(value) != F.max(value)).alias("conflict")
    )


def equivalent_groups(df: DataFrame, key: Sequence[str], order: str, value: str, exact: Sequence[str], tolerance: float) -> DataFrame:
    """(key, rows, equivalent): whether all rows lie within tolerance of the first by order and agree in `exact`."""
    first = df.groupBy(*key).agg(
        F.min_by(value, order).alias("__v"), F.min(value).alias("__low"), F.max(value).alias("__high"), F.count("*").alias("rows"), F.count_distinct(F.struct(*exact)).alias("__kinds")
    )
    within = (F.col("__high") - F.col("__v") <= tolerance) & (F.col("__v") - F.col("__low") <= tolerance)
    return first.select(*key, "rows", (within & (F.col("__kinds") == 1)).alias("equivalent"))


def field_differences(df: DataFrame, key: str, order: Sequence[str], fields: Mapping[str, float | None]) -> DataFrame:
    """(key, rows, differences): sorted names of fields in which a row differs from the first by order.

    A number after a field's name is its tolerance; nulls differ from values.
    """
    place = Window.partitionBy(key).orderBy(*order)
    marks = df.withColumns({f"__{f}": F.first(f).over(place) for f in fields})
    flags = [
        F.max(F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")) if t is None else F.coalesce(F.abs(F.col(f) - F.col(f"__{f}")) > t, ~F.col(f).eqNullSafe(F.col(f"__{f}"))), F.lit(f))).alias(f"__m_{f}")
        for f, t in fields.items()
    ]
    return marks.groupBy(key).agg(F.count("*").alias("rows"), *flags).select(key, "rows", F.array_join(F.array_sort(F.array_compact(F.array(*[f"__m_{f}" for f in fields]))), "|").alias("differences"))


def previous_conflicts(df: DataFrame, key: str, order: str, value: str, tolerance: float) -> DataFrame:
    """Rows whose value lies further than tolerance from that of the row before with the same key."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("previous", before).where(F.abs(F.col(value) - F.col("previous")) > tolerance)


def occurrence_status(df: DataFrame, key: str, variant: str, order: Sequence[str], fields: Sequence[str], keep: str = "last") -> DataFrame:
    """(key, status, rows, variants, chosen) of all places where a key occurs.

    ok: once. duplicado_equivalente: several, equal in all fields and variant. id_high_expandido:
    equal but for variant. duplicado_divergente: else. chosen is the kept row's order, as a struct.
    """
    pick = F.max if keep == "last" else F.min
    grouped = df.groupBy(key).agg(F.count("*").alias("rows"), F.count_distinct(variant).alias("variants"), F.count_distinct(F.struct(*fields)).alias("__kinds"), pick(F.struct(*order)).alias("chosen"))
    status = F.when(F.col("rows") == 1, "ok").when(F.col("__kinds") > 1, "duplicado_divergente").when(F.col("variants") > 1, "id_high_expandido").otherwise("duplicado_equivalente")
    return grouped.select(key, status.alias("status"), "rows", "variants", "chosen")


def wanted_status(wanted: DataFrame, places: DataFrame, key: str, variant: str, order: Sequence[str], fields: Sequence[str], failed: str | None = None, keep: str = "last") -> DataFrame:
    """(key, status, rows, chosen) of each wanted key: where it is taken from among its places.

    ausente: it has none. erro: a place of it couldn't be read (failed is true). duplicado_divergente:
    places differ in a field (variant doesn't count). duplicado_resolvido: several equal ones. ok: one.
    chosen is the kept place's order; null without one. A wanted key that repeats counts once.
    """
    found = occurrence_status(places, key, variant, order, fields, keep).select(key, "rows", "chosen", (F.col("status") == "duplicado_divergente").alias("__apart"))
    bad = places.groupBy(key).agg(F.max(F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)).alias("__failed"))
    status = F.when(F.col("rows").isNull(), "ausente").when(F.col("__failed"), "erro").when(F.col("__apart"), "duplicado_divergente").when(F.col("rows") > 1, "duplicado_resolvido").otherwise("ok")
    out = wanted.select(key).distinct().join(found, key, "left").join(bad, key, "left").withColumn("status", status)
    return out.select(key, "status", F.coalesce("rows", F.lit(0)).alias("rows"), F.when(F.col("status").isin("ok", "duplicado_resolvido"), F.col("chosen")).alias("chosen"))


# Which states of a mapping are good, and bytes of an archive's parts.
COMPATIBLE = ("ok", "duplicado_equivalente", "id_high_expandido")
ARCHIVE_HEAD, ARCHIVE_ENTRY, MEDIA_EXTRA = 12, 40, 12


def mapping_summary(mapped: DataFrame) -> DataFrame:
    """One row: counts by status, the lowest and highest change of duration, and the bytes of an archive of it all.

    mapped: status, entries, delta_pct, media_bytes, aside_bytes. The size has a head with a count of
    six bits in the first byte and seven in each further one, and for each entry its index and both parts.
    """
    is_ = lambda *names: F.count_if(F.col("status").isin(*names))
    taken = F.col("status").isin(*COMPATIBLE)
    out = mapped.agg(
        is_(*COMPATIBLE).alias("compatible"), F.coalesce(F.sum(F.when(taken, F.col("entries"))), F.lit(0)).alias("entries"), is_("ausente").alias("missing"), is_("duplicado_equivalente").alias("duplicates"),
        is_("id_high_expandido").alias("expanded"), is_("duplicado_divergente").alias("divergent"), is_("incompatível", "erro").alias("incompatible"), is_("ignorado").alias("ignored"),
        F.min(F.when(taken, F.col("delta_pct"))).alias("least_delta"), F.max(F.when(taken, F.col("delta_pct"))).alias("most_delta"),
        F.coalesce(F.sum(F.when(taken, F.col("entries") * (F.col("media_bytes") + MEDIA_EXTRA + F.col("aside_bytes")))), F.lit(0)).alias("payload"),
    )
    count_bytes = F.when(F.col("entries") < 64, 1).otherwise(1 + F.ceil((F.floor(F.log2(F.col("entries"))) + 1 - 6) / 7))
    size = ARCHIVE_HEAD + count_bytes + ARCHIVE_ENTRY * F.col("entries") + F.col("payload")
    return out.withColumn("bytes", F.when(F.col("entries") > 0, size).cast("long")).drop("payload")


def payload_mismatches(written: DataFrame, sources: DataFrame, key: Sequence[str], payloads: Sequence[str], numbers: Mapping[str, float]) -> DataFrame:
    """(key, problem) of written entries that aren't their source byte by byte: missing, extra, or differing parts.

    payloads are compared by their SHA-256 (binary columns, hashed where they are), numbers within
    a tolerance.
    """
    parts = lambda df: [F.sha2(F.col(c), 256).alias(f"__{c}") for c in payloads] + [F.col(c).cast("double").alias(f"__{c}") for c in numbers]
    a, b = written.select(*key, *parts(written), F.lit(True).alias("__in")), sources.select(*key, *parts(sources), F.lit(True).alias("__in"))
    both = a.alias("a").join(b.alias("b"), list(key), "full")
    flags = [F.when(~F.col(f"a.__{c}").eqNullSafe(F.col(f"b.__{c}")), c) for c in payloads]
    flags += [F.when(F.coalesce(F.abs(F.col(f"a.__{c}") - F.col(f"b.__{c}")) > t, ~F.col(f"a.__{c}").eqNullSafe(F.col(f"b.__{c}"))), c) for c, t in numbers.items()]
    problem = F.when(F.col("a.__in").isNull(), "missing").when(F.col("b.__in").isNull(), "extra").otherwise(F.array_join(F.array_compact(F.array(*flags)), "|"))
    return both.select(*key, problem.alias("problem")).where("problem <> ''")


def too_small(files: DataFrame, length: str = "length", least: int = 44) -> DataFrame:
    """Files that hold no more than `least` bytes (a header alone), or are missing (null)."""
    return files.where(F.coalesce(F.col(length), F.lit(0)) <= least)


def join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join by a key that must be unique on the right; raises if it isn't."""
    require_none(duplicates(right, key), f"{key} repeats")
    return left.join(right, key)


def most_common(df: DataFrame, *columns: str, n: int | None = None) -> DataFrame:
    """(columns, rows) by falling count, ties by the columns; the n first, if given."""
    out = df.groupBy(*columns).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *columns)
    return out if n is None else out.limit(n)


def distinct_profiles(df: DataFrame, by: str, *profile: str) -> DataFrame:
    """(by, rows, profiles): how many rows, and how many different combinations of the profile columns (nulls are values)."""
    each = df.groupBy(by, *profile).agg(F.count("*").alias("rows"))
    return each.groupBy(by).agg(F.sum("rows").alias("rows"), F.count("*").alias("profiles"))


def coverage(labelled: DataFrame, key: str, label: str, names: Sequence[str]) -> DataFrame:
    """(categoria, quantidade): distinct keys of each name, also where nothing bears it."""
    have = labelled.select(F.col(label).alias("categoria"), key).distinct().groupBy("categoria").agg(F.count("*").alias("quantidade"))
    every = labelled.sparkSession.createDataFrame([(n,) for n in names], "categoria string")
    return every.join(have, "categoria", "left").select("categoria", F.coalesce("quantidade", F.lit(0)).alias("quantidade"))


def coverage_ids(labelled: DataFrame, key: str, label: str, names: Sequence[str], joiner: str = ",") -> DataFrame:
    """coverage with all sorted ids of a name in one text, for reports that hold few: a name's ids must fit one cell."""
    ids = labelled.select(F.col(label).alias("categoria"), key).distinct().groupBy("categoria").agg(F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), joiner).alias("ids"))
    return coverage(labelled, key, label, names).join(ids, "categoria", "left").withColumn("ids", F.coalesce("ids", F.lit("")))


# What the coverage gate takes as good.
GOOD_MAPPING, GOOD_PROCESSING = ("ok", "duplicado_equivalente", "id_high_expandido", "ignorado"), ("ok", "aviso_curta", "aviso_longa")


def coverage_labels(manifest: DataFrame, recorded: DataFrame, packed: DataFrame, mapping: DataFrame, processing: DataFrame) -> DataFrame:
    """(ident, categoria): all that a coverage report counts.

    manifest: ident, action, review; recorded and packed: ident; mapping and processing: ident,
    status. An empty mapping or processing isn't checked. All comes from one aggregation by ident.
    """
    seen = {"gerar": manifest.where("action = 'gerar'"), "usar_original": manifest.where("action = 'usar_original'"), "revisao_pendente": manifest.where("trim(review) <> ''"), "recorded": recorded, "packed": packed}
    for name, report, good in (("processing", processing, GOOD_PROCESSING), ("mapping", mapping, GOOD_MAPPING)):
        seen |= {name: report, f"bad_{name}": report.where(~F.coalesce("status", F.lit("ausente")).isin(*good))}
    rows = memberships(seen, "ident")
    for name, report in (("processing", processing), ("mapping", mapping)):
        rows = rows.crossJoin(F.broadcast(report.limit(1).agg((F.count("*") > 0).alias(f"checked_{name}"))))  # one row
    c = F.col
    wrong = lambda name: c("gerar") & c(f"checked_{name}") & (c(f"bad_{name}") | ~c(name))
    found = {
        "gerar": c("gerar"), "usar_original": c("usar_original"), "revisao_pendente": c("revisao_pendente"), "wav_faltando": c("gerar") & ~c("recorded"), "wem_faltando": c("gerar") & ~c("packed"),
        "wav_extra": c("recorded") & ~c("gerar"), "wem_extra": c("packed") & ~c("gerar"), "pos_processamento_invalido": wrong("processing"), "mapeamento_invalido": wrong("mapping"),
    }
    return rows.select("ident", F.explode(F.array_compact(F.array(*[F.when(held, name) for name, held in found.items()]))).alias("categoria"))


def coverage_gate(labels: DataFrame) -> None:
    """Raises while a line to be generated lacks a file or has a bad state, then while one waits for review; extra files pass."""
    failing = labels.where(F.col("categoria").isin("wav_faltando", "wem_faltando", "mapeamento_invalido", "pos_processamento_invalido"))
    require_none(failing, "coverage is incomplete")
    require_none(labels.where("categoria = 'revisao_pendente'"), "lines wait for review")


def fixed_domain_counts(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    every = df.sparkSession.createDataFrame([(n,) for n in names], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def catalogue_counts(df: DataFrame, group: str, kind: str, groups: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """One row a catalogue entry with a count for each kind, the total and its share of all rows."""
    every = df.sparkSession.createDataFrame([(g,) for g in groups], f"{group} string")
    counts = df.groupBy(group).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds], F.count("*").alias("total"))
    out = every.join(counts, group, "left").na.fill(0, [*kinds, "total"])
    return out.join(F.broadcast(df.agg(F.count("*").alias("__all")))).withColumn("share", F.col("total") / F.greatest(F.lit(1), F.col("__all"))).drop("__all")


def valid_media(tag: Column, format_size: Column, channels: Column, wanted_channels: Column, rate: Column, has_seek: Column) -> Column:
    return (tag == 0x3041) & (format_size == 36) & (channels == wanted_channels) & (rate == 48_000) & has_seek
