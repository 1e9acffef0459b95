"""Risk scores, priorities, plans and decisions, as column arithmetic.

Missing measurements are null, never NaN, so that no comparison with them holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LETTER, cents_apart, clip, reasons


def points(*rules: tuple[Column, float]) -> Column:
    """Points of the first rule that holds, else 0."""
    out = F.when(rules[0][0], F.lit(float(rules[0][1])))
    for condition, value in rules[1:]:
        out = out.when(condition, F.lit(float(value)))
    return out.otherwise(0.0)


def quality_risk(m: DataFrame) -> DataFrame:
    """Adds risk and reasons to audio measurements.

    m has raw_micro, final_micro, punctuation, raw_blips, final_blips, tail_island_ms,
    tail_margin_ms, processing_speed, effective_speed, syllable_pct, syllable_rate, letter_pct,
    letter_rate, raw_pause_pct, final_pause_pct, clipping, max_step, duration_change.
    """
    c = F.col
    excess = F.greatest(F.lit(0), c("raw_micro") - c("punctuation") - 1)
    blips = (c("raw_blips") > 0) | (c("final_blips") > 0)
    speed = F.greatest("processing_speed", "effective_speed")
    dense = (c("syllable_pct") >= 99.5) & (c("syllable_rate") >= 7)
    quick = (c("syllable_pct") >= 97.5) & (c("syllable_rate") >= 6.5)
    crowded = (c("letter_pct") >= 99.5) & (c("letter_rate") >= 18)
    raw_pause = (c("raw_pause_pct") >= 99) & (c("raw_micro") >= c("punctuation") + 2)
    final_pause = (c("final_pause_pct") >= 98) & (c("final_micro") >= c("punctuation") + 2)
    clipped = c("clipping") >= 0.0005
    risk = (
        points((excess >= 3, 38), (excess == 2, 24), (excess == 1, 10)) + points((blips, 40))
        + points(((c("tail_island_ms") > 0) & (c("tail_island_ms") <= 100), 42), (c("tail_island_ms") > 100, 16))
        + points((c("tail_margin_ms") < 25, 30), (c("tail_margin_ms") < 45, 12)) + points((speed >= 1.18, 26), (speed >= 1.12, 14))
        + points((dense, 30), (quick, 16), (crowded, 20)) + points((raw_pause, 20), (final_pause, 12))
        + points((clipped, 45), (c("max_step") >= 28, 18)) + points((F.abs(c("duration_change")) >= 40, 12))
    )
    why = reasons([
        (excess >= 2, "micropausas"), (blips, "interrupção"), (c("tail_island_ms") > 0, "ilha final"), (c("tail_margin_ms") < 45, "margem final"), (speed >= 1.12, "velocidade"),
        (dense | quick | crowded, "densidade"), (raw_pause | final_pause, "pausas"), (clipped, "clipping"), (~clipped & (c("max_step") >= 28), "salto"), (F.abs(c("duration_change")) >= 40, "duração"),
    ])
    return m.withColumn("risk", risk).withColumn("reasons", why)


def percentile_priority(percentile: Column, hard_failure: Column) -> Column:
    return F.when(hard_failure, "alta").when(percentile >= 99, "alta").when(percentile >= 97.5, "media").when(percentile >= 95, "baixa").otherwise("ok")


def identity_risk(f0: Column, under160: Column, under170: Column, z: Column, known: Column | None = None, failed: Column | None = None) -> Column:
    """0 to 100; 100 for lines known by ear to be wrong and for those whose recording couldn't be read."""
    sure = F.coalesce(known, F.lit(False)) if known is not None else F.lit(False)
    sure = sure | F.coalesce(failed, F.lit(False)) if failed is not None else sure
    points = clip((185 - f0) / 45, 0.0, 1.0) * 45 + under160 * 30 + under170 * 15 + clip((-z - 1.5) / 3, 0.0, 1.0) * 10
    return F.when(sure, 100.0).otherwise(clip(points, 0.0, 100.0))


def identity_priority(f0: Column, u160: Column, u170: Column, u180: Column, z: Column, known: Column, failed: Column | None = None) -> Column:
    return (
        F.when(known if failed is None else known | failed, "alta").when((f0 <= 155) & (u160 >= 0.70), "alta").when((f0 <= 168) & (u170 >= 0.70), "media")
        .when((f0 <= 180) & (u180 >= 0.70), "baixa").when((z <= -3.5) & (u170 >= 0.45), "baixa").otherwise("ok")
    )


def version_priority(words: Column, duration: Column, current: Column, gap: Column) -> Column:
    """How much a line's current pitch fell from its earlier versions (gap in Hz)."""
    full = (words >= 2) & (duration >= 0.8)
    return (
        F.when(full & (current <= 160) & (gap >= 35), "alta").when(full & (current <= 175) & (gap >= 30), "media")
        .when(~full & (current <= 165) & (gap >= 35), "curta").otherwise("ok")
    )


# Names of decisions and review folders.
DECISIONS = ("vocalizacao_curta_inconclusiva", "forte_suspeita_masculina", "suspeita_moderada", "pitch_insuficiente", "provavel_falso_positivo")
FOLDERS = ("01_forte_suspeita_masculina", "02_falas_revisao_manual", "03_vocalizacoes_curtas", "04_falsos_positivos_pyin")


def pitch_decision(words: Column, duration: Column, frames: Column, median: Column, share: Column) -> Column:
    short, strong, moderate, few, none = DECISIONS
    enough = frames >= 8
    return (
        F.when((words <= 1) | (duration < 0.8), short).when(enough & (median <= 155) & (share >= 0.65), strong)
        .when(enough & (median <= 172) & (share >= 0.55), moderate).when(frames < 8, few).otherwise(none)
    )


def review_folder(decision: Column, text: Column) -> Column:
    """Lines with too little pitch go to the manual folder if they have two words and aren't laughter, else to the short ones."""
    short, strong, moderate, few, _ = DECISIONS
    first, manual, brief, rest = FOLDERS
    spoken = (F.regexp_count(text, F.lit(f"{LETTER}+")) >= 2) & ~F.contains(F.lower(text), F.lit("ha, ha"))
    return F.when(decision == strong, first).when((decision == moderate) | (decision == few) & F.coalesce(spoken, F.lit(False)), manual).when(decision.isin(few, short), brief).otherwise(rest)


def attempt_score(median: Column, target: Column, share: Column, frames: Column, probability: Column, duration: Column, original: Column) -> Column:
    """Lower is better; 10000 without a pitch."""
    distance = F.when(target.isNotNull(), cents_apart(median, target) / 50).otherwise(F.abs(median - 195) / 5)
    low = F.when(median < 150, 160 + (150 - median) * 3).when(median < 165, 80 + (165 - median) * 2).otherwise(0.0)
    length = F.when((duration > 0) & (original > 0), F.abs(F.log(duration / original)) * 2).otherwise(0.0)
    score = distance + low + F.coalesce(share, F.lit(0.0)) * 28 + points((frames < 4, 35)) + F.when(probability < 0.45, (0.45 - probability) * 30).otherwise(0.0) + length
    return F.when(median.isNull(), 10000.0).otherwise(score)


def expressiveness(span: Column, spread: Column, motion: Column, energy: Column, pauses: Column, pause_ratio: Column) -> Column:
    """Weighted robust z scores, each within -3..3, less a penalty for long pauses."""
    part = lambda z, w: clip(z, -3.0, 3.0) * w
    return part(span, 0.35) + part(spread, 0.20) + part(motion, 0.10) + part(energy, 0.25) + part(pauses, 0.10) - F.greatest(F.lit(0.0), pause_ratio - 0.35)


def _allowed(original: Column, limit_pct: float, limit_s: float) -> Column:
    return F.greatest(original * (1 + limit_pct / 100), original + limit_s)


def duration_plan(original: Column, trimmed: Column, limit_pct: float = 15.0, fastest: float = 1.20, least_ratio: float = 0.60, limit_s: float = 0.50) -> Column:
    """(speed, final, delta_pct, status) that brings a trimmed line near its original length.

    The speed aims at the limit in percent, less a margin of 2 % of the original but 20 ms at most
    (filters add a little); the absolute limit only decides whether what comes out is too long.
    """
    aim = F.greatest(original, original * (1 + limit_pct / 100) - F.least(F.lit(0.020), original * 0.02))
    speed = F.least(F.greatest(F.lit(1.0), trimmed / aim), F.lit(fastest))
    final = trimmed / speed
    short, long = final < original * least_ratio, final > _allowed(original, limit_pct, limit_s) + 0.001
    status = F.when(short, "revisar_curta").when(long, "revisar_longa").otherwise("ok")
    return F.struct(speed.alias("speed"), final.alias("final"), ((final / original - 1) * 100).alias("delta_pct"), status.alias("status"))


def final_status(original: Column, final: Column, limit_pct: float = 15.0, least_ratio: float = 0.60, limit_s: float = 0.50, strict: bool = False) -> Column:
    """Of a finished line; a verdict blocks only if strict."""
    prefix = "revisar_" if strict else "aviso_"
    return F.when(final < original * least_ratio, prefix + "curta").when(final > _allowed(original, limit_pct, limit_s) + 0.02, prefix + "longa").otherwise("ok")


def exact_length_plan(duration: Column, target: Column, trim: float = 0.30, pad: float = 0.08) -> Column:
    """(action, seconds): cut from both ends, fill up, leave, or reject."""
    diff = duration - target
    return F.struct(
        F.when(F.abs(diff) < 1e-9, "manter").when((diff > 0) & (diff <= trim), "aparar").when((diff < 0) & (-diff <= pad), "preencher").otherwise("rejeitar").alias("action"),
        F.abs(diff).alias("seconds"),
    )


def replacement_problems(old_codec: Column, new_codec: Column, old_channels: Column, new_channels: Column, old_rate: Column, new_rate: Column) -> Column:
    return F.array_compact(F.array(F.when(new_codec != "wem-opus", "codec_invalido"), F.when(old_codec != new_codec, "codec"), F.when(old_channels != new_channels, "canais"), F.when(old_rate != new_rate, "sample_rate")))


def term_priority(risky: Column, count: Column) -> Column:
    return F.when(risky, "alta").when(count >= 20, "alta").when(count >= 5, "media").when(count >= 2, "baixa").otherwise("rara")


def scope_advice(ambiguous: Column, phrase: Column) -> Column:
    return F.when(ambiguous, "ambiguo").when(phrase, "frase").otherwise("termo")


def version_summary(pairs: DataFrame, group: str) -> DataFrame:
    """Medians of (old - new) by group with remarks; pairs has old_ and new_ columns of pitch, energy,
    duration, pause. Ratios leave out rows whose new duration isn't positive."""
    out = pairs.groupBy(group).agg(
        F.median(F.col("old_pitch") - F.col("new_pitch")).alias("pitch_delta"), F.median(F.col("old_energy") - F.col("new_energy")).alias("energy_delta"),
        F.median(F.when(F.col("new_duration") > 0, F.col("old_duration") / F.col("new_duration"))).alias("duration_ratio"), F.median(F.col("old_pause") - F.col("new_pause")).alias("pause_delta"),
    )
    p, e, d, s = (F.col(x) for x in ("pitch_delta", "energy_delta", "duration_ratio", "pause_delta"))
    return out.withColumn("remarks", reasons([
        (p >= 0.75, "altura mais variada"), (p <= -0.75, "altura menos variada"), (F.abs(p) < 0.75, "altura semelhante"), (e >= 1.5, "energia maior"), (e <= -1.5, "energia menor"),
        (d < 0.90, "mais curta"), (d > 1.10, "mais longa"), (s >= 0.04, "mais pausas"), (s <= -0.04, "menos pausas"),
    ]))
