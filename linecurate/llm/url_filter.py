"""URL filtering by given rules and by association rules mined from labelled pages (DataFrame functions and FP-growth only).

Given rules name a host and the start of a path and are found by the host's endings. Where none
fits, tokens of the url are looked up in an inverted index of mined token combinations that stand
for unwanted pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import cut, shuffle_partitions

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
LEAST, SHARE = 4, 0.002  # unwanted urls that a combination occurs in, at least: so many, and this share of them
CONFIDENCE = 0.8
LONGEST = 3  # tokens of a combination
SMALL = 100_000  # rows that are broadcast at most; they are counted
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL else df


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, host, path); both are empty for a null url or one without `://`."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substr("url", at + 3)).otherwise("")
    return pages.select("page_id", rest.alias("__r")).select(
        "page_id", F.translate(F.regexp_extract("__r", "^[^/?#]*", 0), _UPPER, _LOWER).alias("host"), F.regexp_extract("__r", "^[^/?#]*([^?#]*)", 1).alias("path")
    )


def tokens() -> Column:
    """Distinct tokens of host and path: host labels and their pieces (h:), pieces of the path (p:) but numbers."""
    host = F.array_union(F.split("host", "[.]"), F.split("host", _SPLIT))
    path = F.filter(F.split(F.translate("path", _UPPER, _LOWER), _SPLIT), lambda x: ~x.rlike("^[0-9]*$"))
    marked = lambda words, mark: F.transform(F.filter(words, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    return F.array_distinct(F.concat(marked(host, "h:"), marked(path, "p:")))


def given_verdicts(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(host, path, rule, verdict) of the urls that a given rule fits: the longest one, ties to the longer host."""
    split = [(rule, *rule.partition("/")[::2], verdict) for rule, verdict in rules]
    if not split:
        return urls.select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict")).limit(0)
    table = urls.sparkSession.createDataFrame([(r, h, "/" + p, v) for r, h, p, v in split], "rule string, __h string, __p string, verdict string")
    depth = max(h.count(".") + 1 for _, h, _, _ in split)
    labels = F.split("host", "[.]")
    endings = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    fits = urls.select("host", "path", F.explode(endings).alias("__h")).join(_few(table), "__h").where(F.startswith("path", "__p"))
    best = F.max(F.struct(F.char_length("rule").alias("n"), F.char_length("__h").alias("h"), "rule", "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def matches(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """(host, path, needs) for each url (host, path, tokens) and mined rule (key, needs) all of whose tokens it has.

    Rules are posted under their rarest token. A url first loses the tokens that no rule has, so
    that what is looked up is as short as the rules allow, however long the url.
    """
    vocabulary = mined.select(F.explode("needs").alias("token")).distinct()
    has = urls.select("host", "path", F.explode("tokens").alias("token")).join(_few(vocabulary), "token", "left_semi").groupBy("host", "path").agg(F.collect_set("token").alias("has"))
    looked_up = has.select("host", "path", "has", F.explode("has").alias("key")).join(_few(mined.select("key", "needs")), "key")
    return looked_up.where(F.size(F.array_intersect("needs", "has")) == F.size("needs")).select("host", "path", "needs")


def mine(examples: DataFrame, least: int = LEAST, share: float = SHARE, confidence: float = CONFIDENCE, longest: int = LONGEST) -> DataFrame:
    """(needs, key, n_bad, n_all) of the token combinations that stand for unwanted urls.

    examples has host, path, tokens and bad, one row a url. FP-growth runs over the unwanted ones;
    a combination has to occur in `least` of them and in `share` of them. How many urls it occurs
    in at all comes from the inverted index over all examples; rules below `confidence` go. Tokens
    that occur in just the same examples are one item (the smallest stands for them), so that urls
    with a long common part don't make all its combinations. Frequent tokens number at most the
    tokens of an unwanted url, on average, over `share`.
    """
    spark = examples.sparkSession
    words = examples.select("bad", F.xxhash64("host", "path").alias("u"), F.explode("tokens").alias("token"))
    n_bad = examples.where("bad").count()
    enough = max(least, -(-int(share * 1_000_000) * n_bad // 1_000_000))
    per = words.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.bit_xor("u").alias("x")).where(F.col("n_bad") >= enough)
    items = cut(per.groupBy("n", "x").agg(F.min("token").alias("token")).select("token", "n"))
    bags = cut(words.where("bad").join(_few(items), "token").groupBy("u").agg(F.collect_list("token").alias("items")))
    size = bags.count()
    if not size:
        return spark.createDataFrame([], "needs array<string>, key string, n_bad long, n_all long")
    grown = FPGrowth(itemsCol="items", minSupport=(enough - 0.5) / size, minConfidence=confidence, numPartitions=shuffle_partitions(spark)).fit(bags)
    sets = grown.freqItemsets.where(F.size("items") <= longest).select(F.array_sort("items").alias("needs"), F.col("freq").alias("n_bad"))
    rarest = sets.select("needs", "n_bad", F.explode("needs").alias("token")).join(_few(items), "token").groupBy("needs", "n_bad").agg(F.min_by("token", F.struct("n", "token")).alias("key"))
    found = cut(rarest)
    everywhere = matches(examples, found).groupBy("needs").agg(F.count("*").alias("n_all"))
    return cut(found.join(everywhere, "needs").where(F.col("n_bad") >= confidence * F.col("n_all")).select("needs", "key", "n_bad", "n_all"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict.

    pages has page_id and url, labels doc_id (a page's id) and quality; a page of quality 0 is an
    unwanted example, others with a quality are wanted ones, and a url with both is unwanted. Other
    columns are ignored. A given rule that fits decides, the longest first; rule is null where none
    fits, and the url is blocked if it has all tokens of a mined rule, else allowed. Null urls and
    those without `://` have an empty host and path and no tokens: they are allowed unless a rule
    says otherwise. Rows that repeat a page_id or a url, or have no page_id, are judged alike.
    Without labels nothing is mined; an empty table gives an empty result.

    Each different (host, path) is judged once and joined back, an equi-join with one row a key on
    its right, so a hot url is split by adaptive execution.
    """
    rows = parsed(pages)
    urls = rows.select("host", "path").distinct()
    known = labels.where("quality is not null").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    examples = cut(rows.join(known, "page_id").groupBy("host", "path").agg(F.max("bad").alias("bad")).withColumn("tokens", tokens()))
    given = cut(given_verdicts(urls, rules))
    open_ = urls.join(given, ["host", "path"], "left_anti").withColumn("tokens", tokens())
    blocked = matches(open_, mine(examples)).select("host", "path").distinct().select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"))
    return rows.join(given.unionByName(blocked), ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def op12_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all `pages`, with rules mined from `labels`."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: all combinations of up to three tokens, counted one by one
OP12_SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
urls AS (SELECT DISTINCT host, path FROM parsed),
fixed(rule, host, path, verdict) AS (VALUES {', '.join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in RULES)}),
given AS (
  SELECT u.host, u.path, max((length(f.rule), length(f.host), f.rule, f.verdict)) AS b
  FROM urls u JOIN fixed f ON (u.host = f.host OR ends_with(u.host, '.' || f.host)) AND starts_with(u.path, f.path) GROUP BY u.host, u.path),
words AS (
  SELECT DISTINCT host, path, token FROM (
    SELECT host, path, unnest(list_concat(
      list_transform(list_concat(string_split(host, '.'), regexp_split_to_array(host, '{_SPLIT}')), lambda x: CASE WHEN x <> '' THEN 'h:' || x END),
      list_transform(regexp_split_to_array(translate(path, '{_UPPER}', '{_LOWER}'), '{_SPLIT}'), lambda x: CASE WHEN NOT regexp_full_match(x, '[0-9]*') THEN 'p:' || x END))) AS token
    FROM urls) WHERE token IS NOT NULL),
examples AS (SELECT host, path, bool_or(quality = 0) AS bad FROM parsed JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY host, path),
enough AS (SELECT greatest({LEAST}, (count(*) * {int(SHARE * 1_000_000)} + 999999) // 1000000) AS least FROM examples WHERE bad),
seen AS (SELECT host, path, bad, token FROM examples JOIN words USING (host, path)),
per AS (SELECT token, list(host || path ORDER BY host, path) AS places FROM seen GROUP BY token HAVING count(*) FILTER (WHERE bad) >= (SELECT least FROM enough)),
items AS (SELECT min(token) AS token FROM per GROUP BY places),
bags AS (SELECT seen.* FROM seen JOIN items USING (token)),
sets AS (
  SELECT [token] AS needs, bad FROM bags
  UNION ALL SELECT [a.token, b.token], a.bad FROM bags a JOIN bags b ON a.host = b.host AND a.path = b.path AND a.token < b.token
  UNION ALL SELECT [a.token, b.token, c.token], a.bad FROM bags a JOIN bags b ON a.host = b.host AND a.path = b.path AND a.token < b.token
            JOIN bags c ON a.host = c.host AND a.path = c.path AND b.token < c.token),
rules AS (
  SELECT needs FROM sets GROUP BY needs
  HAVING count(*) FILTER (WHERE bad) >= (SELECT least FROM enough) AND count(*) FILTER (WHERE bad) >= {CONFIDENCE}::DOUBLE * count(*)),
has AS (SELECT host, path, list(token) AS has FROM words GROUP BY host, path),
blocked AS (SELECT DISTINCT host, path FROM has JOIN rules ON list_has_all(has, needs))
SELECT page_id, p.host, p.path, g.b[3] AS rule, CASE WHEN g.b IS NOT NULL THEN g.b[4] WHEN k.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM parsed p LEFT JOIN given g ON p.host = g.host AND p.path = g.path LEFT JOIN blocked k ON p.host = k.host AND p.path = k.path
"""
