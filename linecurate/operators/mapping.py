"""Where replacements go: each id's state among the places that archives have for it, and the places that are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of a mapping, and names of what differs between places.
COMPATIBLE = ("ok", "duplicado_equivalente", "id_high_expandido")
_PLACE = ("ident_high", "path", "codec", "channels", "rate", "duration", "trailer_kind", "companion_bytes", "companion_sha256")


def _order() -> Column:
    return F.struct("source_index", "entry_index")


def mapped(replacements: DataFrame, places: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """(ident, status, rows, entries, differences, problems, detail, path, old_codec, new_codec, old_channels, new_channels, old_rate, new_rate, old_duration, new_duration, delta_pct).

    replacements: ident (unique), codec, channels, rate, duration, error (null if it can be read).
    places: ident, ident_high, source_index, entry_index, path, codec, channels, rate, duration,
    trailer_kind, companion_bytes, companion_sha256, error. skipped: ident, left out on purpose.

    ignorado: skipped. ausente: no place. erro: the replacement or a place can't be read.
    duplicado_divergente: places differ from the first by more than id_high (durations by more than
    0.02 s). incompatível: the replacement has another codec, number of channels or rate, or isn't
    of the packed codec. id_high_expandido: places differ by id_high only; each is kept.
    duplicado_equivalente: several alike, of which the last is taken. ok: one. Places are compared
    by aggregates that are combined before the shuffle, so an id with very many costs no more.
    """
    differ = lambda c: ~F.min(c).eqNullSafe(F.max(c))
    first = F.min_by("duration", _order())
    spread = F.greatest(F.max("duration") - first, first - F.min("duration")) > 0.02
    place = F.struct(*_PLACE)
    known = places.join(replacements.select("ident"), "ident", "left_semi")
    # in order of their names
    kinds = {
        "canais": differ("channels"), "codec": differ("codec"), "conteúdo_CR2W": differ("companion_sha256"), "duração": spread, "id_high": differ("ident_high"),
        "sample_rate": differ("rate"), "tamanho_CR2W": differ("companion_bytes"), "trailer_kind": differ("trailer_kind"),
    }
    found = known.groupBy("ident").agg(
        F.count("*").alias("rows"), F.count_distinct("ident_high").alias("highs"), F.min_by("error", F.when(F.col("error").isNotNull(), _order())).alias("bad"),
        F.array_compact(F.array(*[F.when(c, n) for n, c in kinds.items()])).alias("kinds"), F.max_by(place, _order()).alias("last"), F.max_by(place, F.struct(-F.col("ident_high"), _order())).alias("lowest"),
    )
    new = replacements.select("ident", F.struct("codec", "channels", "rate", "duration", "error").alias("new"))
    out = new.join(found, "ident", "left")
    expanded = F.col("kinds") == F.array(F.lit("id_high"))
    apart = (F.size("kinds") > 0) & ~expanded
    out = out.withColumn("old", F.when(expanded, F.col("lowest")).otherwise(F.col("last")))
    changed = lambda name, c: F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.concat(F.lit(name), F.col(f"old.{c}").cast("string"), F.lit(" -> "), F.col(f"new.{c}").cast("string")))
    problems = F.array_compact(F.array(changed("codec ", "codec"), changed("canais ", "channels"), changed("sample rate ", "rate"), F.when(F.col("new.codec") != "wem-opus", F.concat(F.lit("substituto não é WEM Opus: "), F.col("new.codec")))))
    failure = F.coalesce(F.col("new.error"), F.col("bad"))
    status = (
        F.when(F.col("rows").isNull(), "ausente").when(failure.isNotNull(), "erro").when(apart, "duplicado_divergente").when(F.size(problems) > 0, "incompatível")
        .when(expanded, "id_high_expandido").when(F.col("rows") > 1, "duplicado_equivalente").otherwise("ok")
    )
    out = out.withColumn("status", status).withColumn("problems", F.when(F.col("status") == "incompatível", problems))
    note = (
        F.when(expanded, F.concat(F.col("highs").cast("string"), F.lit(" chaves compostas preservadas")))
        .when(F.col("rows") > 1, F.concat(F.col("rows").cast("string"), F.lit(" cópias equivalentes; selecionado "), F.col("last.path")))
    )
    detail = (
        F.when(F.col("status") == "ausente", "ID não encontrado nos pacotes descobertos").when(F.col("status") == "erro", failure)
        .when(F.col("status") == "duplicado_divergente", F.concat(F.lit("cópias divergentes em ["), F.array_join("kinds", ", "), F.lit("]")))
        .otherwise(F.array_join(F.array_compact(F.concat(F.array(note), F.coalesce("problems", F.array().cast("array<string>")))), "; "))
    )
    shown = F.col("status").isin(*COMPATIBLE, "incompatível")
    old = lambda c: F.when(shown, F.col(f"old.{c}"))
    entries = F.when(F.col("status") == "id_high_expandido", F.col("highs")).when(F.col("status").isin(*COMPATIBLE), 1).otherwise(0)
    delta = F.when(F.coalesce(F.col("old.duration"), F.lit(0.0)) == 0, 0.0).otherwise((F.col("new.duration") / F.col("old.duration") - 1) * 100)
    done = out.select(
        "ident", "status", F.coalesce("rows", F.lit(0)).alias("rows"), entries.cast("long").alias("entries"), F.coalesce(F.array_join("kinds", ", "), F.lit("")).alias("differences"), F.coalesce(F.array_join("problems", "; "), F.lit("")).alias("problems"), detail.alias("detail"),
        old("path").alias("path"), old("codec").alias("old_codec"), F.col("new.codec").alias("new_codec"), old("channels").alias("old_channels"), F.col("new.channels").alias("new_channels"),
        old("rate").alias("old_rate"), F.col("new.rate").alias("new_rate"), old("duration").alias("old_duration"), F.col("new.duration").alias("new_duration"), F.when(shown, delta).alias("delta_pct"),
    )
    if skipped is None:
        return done
    left_out = skipped.select("ident").distinct()
    told = left_out.select("ident", F.lit("ignorado").alias("status"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("entries"), F.lit("").alias("differences"), F.lit("").alias("problems"), F.lit("omitido explicitamente").alias("detail"))
    return done.join(left_out, "ident", "left_anti").unionByName(told, allowMissingColumns=True)


def taken(states: DataFrame, places: DataFrame) -> DataFrame:
    """(ident, ident_high, source_index, entry_index, path) of the places that the mapping takes: the last one of each id, or of each (id, id_high) where these are kept apart."""
    use = states.where(F.col("status").isin(*COMPATIBLE)).select("ident", (F.col("status") == "id_high_expandido").alias("__apart"))
    rows = places.join(use, "ident").withColumn("__high", F.when(F.col("__apart"), F.col("ident_high")))
    last = rows.groupBy("ident", "__high").agg(F.max(F.struct("source_index", "entry_index", "ident_high", "path")).alias("p"))
    return last.select("ident", "p.ident_high", "p.source_index", "p.entry_index", "p.path")
