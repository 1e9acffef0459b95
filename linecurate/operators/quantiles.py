"""Exact percentiles of groups of any size.

Small groups use the built-in aggregate, which holds a group's values in one buffer. In a large
one each percentile is bracketed by approximate ones, whose error is known; then the values below
the bracket are counted, and only those inside are put in order, by ranges over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import held, placed_in_order

SMALL = 100_000  # rows of a group that the built-in aggregate may hold
ACCURACY = 10_000


def quantiles(df: DataFrame, value: str, shares: Sequence[float], *groups: str, small: int = SMALL) -> DataFrame:
    """(groups..., n, quantiles): how many values there are, and the exact percentiles with linear interpolation.

    Nulls don't count; a group without a value has n 0 and null quantiles, and a table without rows
    and groups gives one such row. Values are compared and returned as doubles, NaN as the largest.
    """
    names = [f"__g{i}" for i in range(len(groups))]
    own = df.select(*[F.col(g).alias(n) for g, n in zip(groups, names)], F.col(value).cast("double").alias("__v"))
    slack = 2.0 / ACCURACY + 3.0 / max(1, small)  # twice the approximation's error, and three rows of any group that it is used for
    ends = [x for p in shares for x in (max(0.0, p - slack), min(1.0, p + slack))]
    sized = held(own.groupBy(*names).agg(F.count("__v").alias("n"), F.percentile_approx("__v", ends, ACCURACY).alias("__ends")))
    same = lambda a, b: [a[n].eqNullSafe(b[n]) for n in names] or F.lit(True)
    little = sized.where(F.col("n") <= small)
    rows = own.alias("a").join(little.select(*names).alias("b"), [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names], "left_semi") if names else (own if sized.first()["n"] <= small else own.limit(0))
    out = rows.groupBy(*names).agg(F.count("__v").alias("n"), F.percentile("__v", list(shares)).alias("quantiles"))
    if not names:
        out = out.where(F.lit(sized.first()["n"] <= small))
    large = sized.where(F.col("n") > small)
    if large.limit(1).count():
        out = out.unionByName(_selected(own, large, names, shares, same))
    return out.select(*[F.col(n).alias(g) for g, n in zip(groups, names)], "n", "quantiles")


def _selected(own: DataFrame, large: DataFrame, names: list[str], shares: Sequence[float], same) -> DataFrame:
    # groups of more than `small` rows: few beside the rows, and broadcast if they are
    asked = large.select(*[F.col(n).alias(f"{n}b") for n in names], "n", "__ends")
    asked = F.broadcast(asked) if asked.count() <= SMALL else asked
    on = [F.col(n).eqNullSafe(F.col(f"{n}b")) for n in names]
    rows = own.where(F.col("__v").isNotNull()).join(asked, on) if on else own.where(F.col("__v").isNotNull()).crossJoin(asked)
    rows = rows.drop(*[f"{n}b" for n in names])
    low, high = (lambda i: F.col("__ends")[2 * i]), (lambda i: F.col("__ends")[2 * i + 1])
    below = rows.groupBy(*names).agg(F.max("n").alias("n"), F.array(*[F.count_if(F.col("__v") < low(i)) for i in range(len(shares))]).alias("__below"))
    inside = F.array_compact(F.array(*[F.when((F.col("__v") >= low(i)) & (F.col("__v") <= high(i)), F.lit(i)) for i in range(len(shares))]))
    counted = rows.select(*names, "__v", F.explode(inside).alias("__i")).groupBy(*names, "__i", "__v").agg(F.count("*").alias("__c"))
    summed = held(placed_in_order(counted, "__c", *names, "__i", "__v", total_into="__upto"))
    first = summed.groupBy(*names, "__i").agg(F.min("__upto").alias("__start"))
    key = lambda a, b: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    placed = summed.alias("s").join(first.alias("f"), [*key("s", "f"), F.col("s.__i") == F.col("f.__i")]).select("s.*", "f.__start")
    joined = placed.alias("p").join(below.alias("b"), key("p", "b")) if names else placed.alias("p").crossJoin(below.alias("b"))
    at = F.get(F.array(*[F.lit(float(p)) for p in shares]), F.col("__i")) * (F.col("n") - 1)
    ranked = joined.select(*[F.col(f"p.{n}").alias(n) for n in names], "n", F.col("p.__i").alias("__i"), F.col("p.__v").alias("__v"), F.col("p.__c").alias("__c"), (F.get("__below", F.col("__i")) + F.col("__upto") - F.col("__start")).alias("__from"), at.alias("__at"))
    holds = lambda rank: (rank >= F.col("__from")) & (rank < F.col("__from") + F.col("__c"))
    lower, upper = F.floor("__at"), F.ceil("__at")
    two = ranked.groupBy(*names, "__i").agg(F.max("n").alias("n"), F.max("__at").alias("__at"), F.max(F.when(holds(lower), F.col("__v"))).alias("__lo"), F.max(F.when(holds(upper), F.col("__v"))).alias("__hi"))
    same_rank = lower == upper
    between = F.when(same_rank | (F.col("__lo") == F.col("__hi")), F.col("__lo")).otherwise((upper - F.col("__at")) * F.col("__lo") + (F.col("__at") - lower) * F.col("__hi"))
    # a row a share: a handful a group
    return two.groupBy(*names).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("__i", between.alias("q")))).alias("q")).select(*names, "n", F.transform("q", lambda x: x["q"]).alias("quantiles"))
