"""Keyed lookups, updates, merges, set differences, ranking and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .idsets import memberships
from .integrity import duplicates, require_none
from .scan import numbered, running_total


def lookup(df: DataFrame, side: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join to a side with unique keys; its columns named in defaults take them where missing."""
    out = df.join(side.select(key, *defaults), key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def update_join(df: DataFrame, side: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """df with these columns taken from side where it has the key and a value; adds `updated`."""
    side = side.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(side, F.col(key) == F.col("__k"), "left")
    out = out.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns})
    return out.withColumn("updated", F.col("__k").isNotNull()).drop("__k", *[f"__{c}" for c in columns])


def selected(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    return df.join(chosen.select(key), key, "left_semi")


def missing(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key isn't known: the referential check, or set difference by key."""
    return df.join(known.select(key), key, "left_anti")


def key_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): distinct keys that only one side has."""
    both = memberships({"left": left.select(key), "right": right.select(key)}, key)
    return both.where(F.col("left") != F.col("right")).select(key, F.when(F.col("left"), "left").otherwise("right").alias("side"))


def merge_corrections(base: DataFrame, overlay: DataFrame, key: str = "id") -> DataFrame:
    """MERGE of (key, action, text, reason) with a conflict policy; adds `status`.

    New keys are added. Where the base says usar_original and the overlay gerar, the base stays.
    Elsewhere the overlay wins, and its reason is appended unless the base's already holds it.
    Status is adicionado, conflito_mantido_base, inalterado, atualizado, or base (not in the overlay).
    """
    b = base.select(F.col(key), *[F.col(c).alias(f"b_{c}") for c in ("action", "text", "reason")])
    o = overlay.select(F.col(key), *[F.col(c).alias(f"o_{c}") for c in ("action", "text", "reason")])
    m = b.join(o, key, "full_outer")
    new, only = F.col("b_action").isNull(), F.col("o_action").isNull()
    kept = (F.col("b_action") == "usar_original") & (F.col("o_action") == "gerar")
    same = (F.col("b_action") == F.col("o_action")) & F.col("b_text").eqNullSafe(F.col("o_text"))
    held = F.coalesce(F.col("b_reason"), F.lit("")).contains(F.coalesce(F.col("o_reason"), F.lit("")))
    joined = F.when(held, F.col("b_reason")).when(F.coalesce(F.col("b_reason"), F.lit("")) == "", F.col("o_reason")).otherwise(F.concat_ws(" | ", "b_reason", "o_reason"))
    pick = lambda c: F.when(only | kept, F.col(f"b_{c}")).otherwise(F.col(f"o_{c}"))
    return m.select(
        key, pick("action").alias("action"), pick("text").alias("text"),
        F.when(only | kept, F.col("b_reason")).when(new, F.col("o_reason")).otherwise(joined).alias("reason"),
        F.when(only, "base").when(new, "adicionado").when(kept, "conflito_mantido_base").when(same, "inalterado").otherwise("atualizado").alias("status"),
    )


def overlay(layers: Sequence[DataFrame], key: str) -> DataFrame:
    """One row a key from layers with equal columns: the last layer that has it wins."""
    rest = [c for c in layers[0].columns if c != key]
    all_ = None
    for i, layer in enumerate(layers):
        layer = layer.select(key, *rest).withColumn("__p", F.lit(i))
        all_ = layer if all_ is None else all_.unionByName(layer)
    best = all_.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("__p", *rest)).alias("__b"), F.max("__p").alias("layer"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in rest], "layer")


def with_fallback(df: DataFrame, fallback: DataFrame, key: str, labels: Mapping[str, object]) -> DataFrame:
    """df, and the fallback rows with other keys, whose columns named in labels are constants."""
    extra = missing(fallback, df, key).withColumns({c: F.lit(v) for c, v in labels.items()})
    return df.unionByName(extra.select(*[c for c in df.columns if c in extra.columns]), allowMissingColumns=True)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int, into: str = "position") -> DataFrame:
    """The first n rows of each group; ranked before the shuffle too, so large groups stay cheap."""
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col(into) <= n)


def by_priority(column: Column | str, names: Sequence[str]) -> Column:
    """Sort key of an enumeration that isn't alphabetical; unknown names last."""
    c = F.col(column) if isinstance(column, str) else column
    place = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), c).cast("int"), F.lit(0))
    return F.when(place > 0, place).otherwise(len(names) + 1)


def limited(df: DataFrame, n: int) -> DataFrame:
    """n rows, or all for 0."""
    return df.limit(n) if n else df


def systematic_sample(df: DataFrame, key: str, value: str, n: int, mandatory: Sequence[object] = ()) -> DataFrame:
    """n rows evenly spaced by (value, key), the mandatory keys among them; adds `rank` (from 0).

    The places are round(i * (N - 1) / (slots - 1)), half to even, over rows that aren't mandatory
    (N of them), or the middle one if there is one slot; with fewer rows than slots all are taken.
    """
    forced = F.col(key).isin(*mandatory) if mandatory else F.lit(False)
    ranked = running_total(df.withColumn("__one", (~forced).cast("long")), "__one", value, key, into="rank")
    total = df.where(~forced).count()
    slots = max(0, min(n - df.where(forced).count(), total))
    if slots == 1:
        places = df.sparkSession.createDataFrame([(total // 2,)], "rank long")
    else:
        step = F.bround(F.col("id") * float(total - 1) / float(max(1, slots - 1)))
        places = df.sparkSession.range(slots).select(step.cast("long").alias("rank"))
    chosen = ranked.where(F.col("__one") == 1).join(places, "rank", "left_semi")
    return chosen.unionByName(ranked.where(F.col("__one") == 0)).drop("__one")


def annotated(df: DataFrame, notes: DataFrame, key: str, tag: str, default: str) -> DataFrame:
    """Adds `tag` from hand-made notes, the default where there are none, and `conflict` where they differ (the smallest is taken)."""
    marks = notes.groupBy(key).agg(F.min(tag).alias(tag), (F.min(tag) != F.max(tag)).alias("conflict"))
    return df.join(marks, key, "left").withColumns({tag: F.coalesce(F.col(tag), F.lit(default)), "conflict": F.coalesce(F.col("conflict"), F.lit(False))})


def paired_in_order(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """(key, left_place, right_place, moved) of two ordered lists: whether a key stands at another place, or on one side only."""
    place = lambda df, name: numbered(df.select(key, order), order, into=name).select(key, name)
    both = place(left, "left_place").join(place(right, "right_place"), key, "full_outer")
    return both.withColumn("moved", ~F.col("left_place").eqNullSafe(F.col("right_place")))


# How decisions on styles are marked, and styles whose reference is still to be tried.
DECIDED, PENDING_STYLES = "decisao_contextual_final", ("combate_agressivo", "tristeza_contida")


def apply_decisions(classified: DataFrame, decisions: DataFrame, styles: Sequence[str]) -> DataFrame:
    """classified (ident, style, confidence, review, priority, origin, ...) with decisions (ident, style, confidence, reason) applied.

    A decision sets the style, its confidence (media if blank), origin and reason, and ends the
    review. reference_status follows the final style of every row. Decisions on unknown or repeated
    lines and of unknown styles raise.
    """
    require_none(duplicates(classified, "ident"), "repeated lines")
    require_none(missing(decisions, classified, "ident"), "decisions on unknown lines")
    require_none(decisions.where(~F.col("style").isin(*styles)), "unknown styles")
    made = decisions.select("ident", F.struct("style", F.coalesce(F.nullif(F.trim("confidence"), F.lit("")), F.lit("media")).alias("confidence"), "reason").alias("__d"))
    out = classified.join(made, "ident", "left")
    on = F.col("__d").isNotNull()
    pick = lambda name, value: F.when(on, value).otherwise(F.col(name)).alias(name)
    set_ = {"style": F.col("__d.style"), "confidence": F.col("__d.confidence"), "review": F.lit("não"), "priority": F.lit("nenhuma"), "origin": F.lit(DECIDED)}
    kept = [pick(c, set_[c]) if c in set_ else F.col(c) for c in classified.columns]
    final = F.when(on, F.col("__d.style")).otherwise(F.col("style"))
    status = F.when(final.isin(*PENDING_STYLES), "prompt_criado_teste_pendente").otherwise("aprovada_piloto")
    return out.select(*kept, F.col("__d.reason").alias("reason"), status.alias("reference_status"))
