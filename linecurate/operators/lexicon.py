"""Weighted fragments looked up in texts through an index of word runs.

A lexicon is a table of any length: style, fragment, weight, and its place in the style's list. A
counted small lexicon is looked up by the first letters of each word, and the words from there on are
compared with the fragment. For a longer one texts are cut once into runs of as many words as
fragments have, and joined with it; fragments that end in * are found by the first letters of a
run's last word, for each length that the lexicon has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import given

SMALL = 100_000  # fragments that are broadcast at most; they are counted
FRONT = 4  # letters of a word by which fragments are looked up


def table(spark: SparkSession, lexicon: Mapping[str, Sequence[tuple[str, float]]]) -> DataFrame:
    """A lexicon of lists as a table."""
    rows = [(style, i, fragment, float(weight)) for style, fragments in lexicon.items() for i, (fragment, weight) in enumerate(fragments)]
    return spark.createDataFrame(rows, "style string, place int, fragment string, weight double")


def _indexed(lexicon: DataFrame) -> DataFrame:
    """(style, place, weight, words, stem, gram): a fragment's number of words, letters of its last word if it ends in * (else 0), and its text.

    Folded texts have one blank between words and none at the ends, so a fragment that ends in a
    blank stands nowhere.
    """
    bare = F.regexp_replace("fragment", "[*]+$", "")
    stem = F.when(F.endswith("fragment", F.lit("*")), F.char_length(F.element_at(F.split(bare, " "), -1))).otherwise(0)
    usable = lexicon.where((bare != "") & ~F.endswith(bare, F.lit(" ")) & ~F.startswith(bare, F.lit(" ")))
    return usable.select("style", "place", "weight", F.size(F.split(bare, " ")).alias("words"), stem.alias("stem"), bare.alias("gram"))


def _runs(words: Column, n: int, stem: int) -> Column:
    """Runs of n words; with a stem, the last word's first letters only, where it has so many."""
    last = lambda i: F.get(words, i + (n - 1))
    tail = lambda i: F.substring(last(i), 1, stem) if stem else last(i)
    run = (lambda i: tail(i)) if n == 1 else (lambda i: F.concat_ws(" ", F.array_join(F.slice(words, i + 1, n - 1), " "), tail(i)))
    made = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.when(F.char_length(last(i)) >= stem, run(i)) if stem else run(i))
    grams = F.filter(made, lambda g: g.isNotNull())
    keyed = F.transform(F.array_distinct(grams), lambda g: F.struct(F.lit(n).alias("words"), F.lit(stem).alias("stem"), g.alias("gram")))
    return F.when(F.size(words) >= n, keyed).otherwise(F.array().cast("array<struct<words:int,stem:int,gram:string>>"))


def _found_by_front(texts: DataFrame, key: str, folded: str, index: DataFrame) -> DataFrame:
    """(key, style, place, weight) of all places where a fragment of a small index stands.

    A word is looked up by its first FRONT letters, and by fewer where a fragment of one word is a
    shorter stem, so a word gives FRONT rows at most.
    """
    head = F.element_at(F.split("gram", " "), 1)
    letters = F.when((F.col("words") == 1) & (F.col("stem") > 0), F.least("stem", F.lit(FRONT))).otherwise(FRONT)
    fronts = index.select("style", "place", "weight", "words", "stem", "gram", letters.alias("letters"), F.substring(head, F.lit(1), letters).alias("front"))
    lengths = [r["letters"] for r in fronts.select("letters").distinct().orderBy("letters").collect()]
    words = texts.where(F.col(folded).isNotNull()).select(key, F.split(folded, " ").alias("__words"))
    words = words.select(key, "__words", F.posexplode("__words").alias("__at", "__word"))
    asked = words.select("*", F.explode(F.array(*[F.struct(F.lit(n).alias("letters"), F.substring("__word", 1, n).alias("front")) for n in lengths])).alias("__f"))
    asked = asked.select(key, "__words", "__at", "__word", "__f.letters", "__f.front")
    run = F.when(F.col("words") == 1, F.col("__word")).otherwise(F.array_join(F.slice("__words", F.col("__at") + 1, F.col("words")), " "))
    stands = F.when(F.col("stem") > 0, F.startswith(run, F.col("gram"))).otherwise(run == F.col("gram"))
    return asked.join(F.broadcast(fronts), ["letters", "front"]).where(stands).select(key, "style", "place", "weight")


def _found_by_runs(texts: DataFrame, key: str, folded: str, index: DataFrame) -> DataFrame:
    """The same by joining all runs of words. The kinds of fragments (numbers of words, lengths of stems) are read from the index first, a row a kind."""
    kinds = [(r["words"], r["stem"]) for r in index.select("words", "stem").distinct().orderBy("words", "stem").collect()]
    grams = given(F.struct(F.split(folded, " ").alias("w")), lambda x: F.concat(*[_runs(x["w"], n, stem) for n, stem in kinds]))
    grams = texts.where(F.col(folded).isNotNull()).select(key, F.explode(grams).alias("g")).select(key, "g.*")
    return grams.join(index, ["words", "stem", "gram"]).select(key, "style", "place", "weight")


def fragment_scores(texts: DataFrame, key: str, folded: str, lexicon: DataFrame) -> DataFrame:
    """(key, hits) of the texts that hold a fragment: array of (style, score), the weights of each style's fragments added up in their order.

    key is unique. Each fragment counts once a text; * stands for any ending of its last word.
    """
    index = _indexed(lexicon)
    many = index.count()
    if not many:
        return texts.select(key, F.array().cast("array<struct<style:string,score:double>>").alias("hits")).limit(0)
    # a style has one fragment a place, so a set counts each once
    hits = _found_by_front(texts, key, folded, index) if many <= SMALL else _found_by_runs(texts, key, folded, index)
    found = hits.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("style", "place", "weight"))).alias("found"))
    styles = F.array_distinct(F.transform("found", lambda h: h["style"]))
    total = lambda s: F.aggregate(F.filter("found", lambda h: h["style"] == s), F.lit(0.0), lambda acc, h: acc + h["weight"])
    return found.select(key, F.transform(styles, lambda s: F.struct(s.alias("style"), total(s).alias("score"))).alias("hits"))
