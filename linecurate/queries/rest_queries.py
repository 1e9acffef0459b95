"""Queries of sources, sinks and checks that no other module exercises, of mapping states, id sets and the edit cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import portuguese as P
from ..functions import text as T
from ..operators import idsets, integrity, mapping, relational, scoring
from ..plans import prepare
from ..sources import archive, archive_source, sinks, tables
from .source_queries import _media, scratch


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def id_only_lines(spark: SparkSession, d: str) -> DataFrame:
    """Orders as corpus lines of which some have no text, read for their ids."""
    path = scratch(spark, "id_lines")
    line = F.concat_ws("|", F.format_string("%012d", "o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderstatus")))
    _t(spark, d, "orders").select(line.alias("value")).write.mode("overwrite").text(path)
    return tables.read_lines(spark, path, need_text=False).select("ident", "text")


ID_LINES_SQL = "SELECT o_orderkey AS ident, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS text FROM orders"


def comma_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents' first lines as reports with commas, quotes and line feeds in their cells, read back."""
    path = scratch(spark, "commas")
    rows = _t(spark, d, "documents").select("doc_id", F.concat(F.substring("text", 1, 60), F.lit(', "end"\nof '), F.col("lang")).alias("cell"), F.lit("").alias("blank"))
    sinks.write_report(rows, path, ["doc_id", "cell", "blank"], delimiter=",", force=True)
    return tables.read_report(spark, path, "doc_id long, cell string, blank string", delimiter=",")


COMMAS_SQL = "SELECT doc_id, left(text, 60) || ', \"end\"' || chr(10) || 'of ' || lang AS cell, '' AS blank FROM documents"


def json_document(spark: SparkSession, d: str) -> DataFrame:
    """Each region's nations as one JSON document over several lines, read back."""
    path = scratch(spark, "json_documents")
    listed = _t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("nations"))
    text = F.replace(F.to_json(F.struct(F.col("n_regionkey").alias("region"), "nations")), F.lit(","), F.lit(",\n  "))
    files = listed.select(F.format_string("r%d.json", F.col("n_regionkey")).alias("name"), text.cast("binary").alias("content"))
    sinks.write_files(files, path, "name", "content")
    back = tables.read_json(spark, path, "region int, nations array<struct<n_nationkey: int, n_name: string>>")
    return back.select("region", F.explode("nations").alias("n")).select("region", "n.n_nationkey", "n.n_name")


JSON_DOCUMENT_SQL = "SELECT n_regionkey::INT AS region, n_nationkey::INT AS n_nationkey, n_name FROM nation"


def variant_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of suppliers with an id, a style and a variant in their names, listed with these; others are passed over."""
    path = scratch(spark, "variants")
    key = F.col("s_suppkey")
    variant = F.when(key % 4 == 0, "_melhor").when(key % 4 == 1, "_tempo").otherwise("")
    name = F.concat(F.when(key % 7 == 0, "x").otherwise(F.lit("")), T.hex_id("s_suppkey"), F.lit("__estilo_"), F.col("s_nationkey").cast("string"), variant, F.lit(".wav"))
    sinks.write_files(_t(spark, d, "supplier").select(name.alias("name"), F.encode("s_name", "utf-8").alias("content")), path, "name", "content")
    found = tables.list_files(spark, path, tables.VARIANT_NAME, "*.wav")
    return found.select(F.col("g1").alias("id"), F.col("g2").alias("style"), F.col("g3").alias("variant"), F.col("length").cast("long").alias("length"))


VARIANTS_SQL = """
SELECT printf('0x%08x', s_suppkey) AS id, 'estilo_' || s_nationkey AS style, CASE s_suppkey % 4 WHEN 0 THEN 'melhor' WHEN 1 THEN 'tempo' ELSE '' END AS variant, strlen(s_name)::BIGINT AS length
FROM supplier WHERE s_suppkey % 7 <> 0"""


def package_orders(spark: SparkSession, d: str) -> DataFrame:
    """Packages named after nations in natural and in plain order, names of no package left out."""
    n = F.col("n_nationkey")
    names = _t(spark, d, "nation").select(F.when(n % 3 == 0, F.concat(F.lit("content"), n)).when(n % 3 == 1, F.concat(F.lit("dlc"), n)).when(n == 2, "bob").when(n == 5, "ep1").when(n == 8, "content").otherwise(F.lower("n_name")).alias("name"))
    natural, plain = tables.package_order(names).select("name", F.col("source_index").alias("natural")), tables.package_order(names, natural=False).select("name", F.col("source_index").alias("plain"))
    return natural.join(plain, "name")


PACKAGES_SQL = """
WITH p AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'content' || n_nationkey WHEN n_nationkey % 3 = 1 THEN 'dlc' || n_nationkey WHEN n_nationkey = 2 THEN 'bob' WHEN n_nationkey = 5 THEN 'ep1' WHEN n_nationkey = 8 THEN 'content' ELSE lower(n_name) END AS name FROM nation),
q AS (SELECT name, CASE WHEN name LIKE 'content%' THEN 0 ELSE 1 END AS g, regexp_replace(name, '[0-9]+$', '') AS stem, coalesce(try_cast(regexp_extract(name, '([0-9]+)$', 1) AS INT), -1) AS num FROM p WHERE regexp_matches(name, '^(content[0-9]*|bob|ep1|dlc[0-9]+)$'))
SELECT name, row_number() OVER (ORDER BY g, stem, num) - 1 AS "natural", row_number() OVER (ORDER BY g, name) - 1 AS plain FROM q"""


def refused_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A report that is there already isn't written over unless forced: what is read after both attempts."""
    path = scratch(spark, "refused")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_report(orders.where("o_orderkey % 2 = 0"), path, ["o_orderkey", "o_orderstatus"], force=True)
    refused = False
    try:
        sinks.write_report(orders, path, ["o_orderkey", "o_orderstatus"])
    except Exception as e:  # whatever class the session raises, it says so
        refused = "already exists" in str(e).lower()
    return tables.read_report(spark, path, "o_orderkey long, o_orderstatus string").withColumn("refused", F.lit(refused))


REFUSED_SQL = "SELECT o_orderkey, o_orderstatus, true AS refused FROM orders WHERE o_orderkey % 2 = 0"


def media_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether each part is a valid packed medium, what is wrong with it as a replacement, and how it comes to an exact length."""
    size, key = F.col("p_size"), F.col("p_partkey")
    tag, rate = F.when(size % 7 == 0, 0xFFFF).otherwise(0x3041), F.when(size % 5 == 0, 44_100).otherwise(48_000)
    channels, codec = F.when(F.col("p_brand").like("%1"), 2).otherwise(1), F.when(size % 7 == 0, "wem-vorbis").otherwise("wem-opus")
    length = F.col("p_retailprice") / 100
    plan = scoring.exact_length_plan(length, F.round(length, 0), 0.30, 0.08)
    return _t(spark, d, "part").select(
        "p_partkey", integrity.valid_media(tag, F.lit(36), channels, F.lit(1), rate, key % 3 != 0).alias("valid"),
        F.array_join(scoring.replacement_problems(F.lit("wem-opus"), codec, F.lit(1), channels, F.lit(48_000), rate), "|").alias("problems"), plan["action"].alias("action"), F.round(plan["seconds"], 6).alias("seconds"),
    )


MEDIA_SQL = """
SELECT p_partkey, p_size % 7 <> 0 AND p_brand NOT LIKE '%1' AND p_size % 5 <> 0 AND p_partkey % 3 <> 0 AS valid,
  concat_ws('|', CASE WHEN p_size % 7 = 0 THEN 'codec_invalido|codec' END, CASE WHEN p_brand LIKE '%1' THEN 'canais' END, CASE WHEN p_size % 5 = 0 THEN 'sample_rate' END) AS problems,
  CASE WHEN abs(x - round(x)) < 1e-9::DOUBLE THEN 'manter' WHEN x - round(x) BETWEEN 0 AND 0.30::DOUBLE THEN 'aparar' WHEN round(x) - x BETWEEN 0 AND 0.08::DOUBLE THEN 'preencher' ELSE 'rejeitar' END AS action, round(abs(x - round(x)), 6) AS seconds
FROM (SELECT *, p_retailprice / 100 AS x FROM part)"""


def unique_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customers, whose keys must be unique, and how many rows limits of none and of five leave."""
    orders, customers = _t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key")), _t(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    joined = integrity.join_unique(orders, customers, "key")
    counts = relational.limited(joined, 0).agg(F.count("*").alias("all")).crossJoin(relational.limited(joined, 5).agg(F.count("*").alias("five")))
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys")).crossJoin(F.broadcast(counts))


UNIQUE_SQL = """
WITH j AS (SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, count(*) AS orders, sum(o_orderkey)::BIGINT AS keys, (SELECT count(*) FROM j) AS "all", least(5, (SELECT count(*) FROM j)) AS five FROM j GROUP BY c_mktsegment"""


def archive_changes(spark: SparkSession, d: str) -> DataFrame:
    """What changed between two archives of the suppliers."""
    base, key = scratch(spark, "changes"), F.col("s_suppkey")
    rows = _t(spark, d, "supplier")

    def packed(rows: DataFrame, text, kind, side) -> DataFrame:
        return rows.select(key.cast("long").alias("ident"), F.lit(0).alias("ident_high"), _media(text).alias("media"), side.cast("binary").alias("companion"), (F.octet_length(text) / 1000).alias("duration"), kind.alias("trailer_kind"))

    old = packed(rows.where("s_suppkey % 10 <> 1"), F.col("s_name"), F.lit(1), F.lit("side"))
    new = packed(rows.where("s_suppkey % 10 <> 2"), F.when(key % 10 == 3, F.upper(F.concat("s_name", F.lit("xx")))).otherwise(F.col("s_name")), F.when(key % 10 == 4, 2).otherwise(1), F.when(key % 10 == 5, "Side").otherwise("side"))
    for name, items in (("old", old), ("new", new)):
        archive_source.write_archive(items, f"{base}/{name}.w3speech", "ident", force=True)
    read = lambda name: archive_source.read_archives(spark, f"{base}/{name}.w3speech")
    return archive.changed_payloads(read("old"), read("new")).where("change <> 'moved'").select("ident", "change")


CHANGES_SQL = """
SELECT s_suppkey::BIGINT AS ident, CASE s_suppkey % 10 WHEN 1 THEN 'added' WHEN 2 THEN 'removed' WHEN 3 THEN 'payload' WHEN 4 THEN 'metadata' ELSE 'companion' END AS change
FROM supplier WHERE s_suppkey % 10 BETWEEN 1 AND 5"""


def required_files(spark: SparkSession, d: str) -> DataFrame:
    """Customers' files that are missing or hold no more than a head."""
    path = scratch(spark, "required")
    c = _t(spark, d, "customer").select("c_custkey", F.repeat("c_mktsegment", (F.col("c_custkey") % 8 + 1).cast("int")).alias("data"))
    sinks.write_files(c.where("c_custkey % 5 <> 0").select(F.format_string("c%d.bin", "c_custkey").alias("name"), F.col("data").cast("binary").alias("content")), path, "name", "content")
    files = tables.list_files(spark, path, r"^c(\d+)\.bin$", "*.bin").select(F.col("g1").cast("long").alias("c_custkey"), "length")
    return integrity.too_small(c.select("c_custkey").join(files, "c_custkey", "left")).select("c_custkey", F.col("length").cast("long").alias("length"))


REQUIRED_SQL = """
WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN strlen(c_mktsegment) * (c_custkey % 8 + 1) END AS length FROM customer)
SELECT c_custkey, length::BIGINT AS length FROM f WHERE coalesce(length, 0) <= 44"""


def profile_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many different profiles each user's events have, by duration, pace and kind."""
    v = F.col("value")
    events = _t(spark, d, "events").select("user_id", T.duration_band(v / 20).alias("duration"), T.pace_band(v / 10).alias("pace"), "event_type")
    return integrity.distinct_profiles(events, "user_id", "duration", "pace", "event_type")


PROFILES_SQL = """
SELECT user_id, count(*) AS rows, count(DISTINCT (CASE WHEN value / 20 < 1.2 THEN 'curta' WHEN value / 20 < 4 THEN 'media' ELSE 'longa' END, CASE WHEN value / 10 < 4.5 THEN 'lento' WHEN value / 10 <= 7 THEN 'normal' ELSE 'rapido' END, event_type)) AS profiles
FROM events GROUP BY user_id"""


def repeated_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Customers of each nation as positional assignments of that nation's id: the last row counts."""
    path = scratch(spark, "repeated")
    rows = _t(spark, d, "supplier").orderBy("s_suppkey").coalesce(1).select(T.hex_id("s_nationkey").alias("a"), F.when(F.col("s_suppkey") % 6 == 0, "").otherwise(F.col("s_name")).alias("b"))
    rows.write.mode("overwrite").csv(path, sep=";", emptyValue="")
    return tables.read_assignments(spark, path)


REPEATED_SQL = """
SELECT printf('0x%08x', s_nationkey) AS id, CASE WHEN max(s_suppkey) % 6 = 0 THEN 'sem_estilo' ELSE max_by(s_name, s_suppkey) END AS style FROM supplier GROUP BY s_nationkey"""


def idset_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of orders that are open, dear, have a line returned, or come early: each pair of these sets against each other."""
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    sets = {
        "open": o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k")), "dear": o.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("k")),
        "returned": li.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")), "none": o.where("o_orderkey < 0").select(F.col("o_orderkey").alias("k")),
    }
    return idsets.overlaps(sets, "k")


OVERLAPS_SQL = """
WITH s AS (SELECT 1 AS i, 'open' AS n, o_orderkey AS k FROM orders WHERE o_orderstatus = 'O' UNION SELECT 2, 'dear', o_orderkey FROM orders WHERE o_totalprice > 200000 UNION SELECT 3, 'returned', l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT * FROM (VALUES (1, 'open'), (2, 'dear'), (3, 'returned'), (4, 'none')) v(i, n)),
p AS (SELECT a.n AS a, b.n AS b, a.i AS i, b.i AS j FROM n a JOIN n b ON a.i < b.i),
c AS (SELECT p.a, p.b, (SELECT count(*) FROM s x JOIN s y USING (k) WHERE x.i = p.i AND y.i = p.j) AS "both", (SELECT count(*) FROM s WHERE s.i = p.i) AS na, (SELECT count(*) FROM s WHERE s.i = p.j) AS nb FROM p)
SELECT a, b, "both", na + nb - "both" AS either, na - "both" AS only_a, nb - "both" AS only_b FROM c"""


def _places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as replacements, and up to three places of each in archives; some differ, can't be read, or aren't there."""
    key, size = F.col("p_partkey"), F.col("p_size")
    part = _t(spark, d, "part")
    new = part.select(
        key.alias("ident"), F.when(size % 11 == 0, "pcm").otherwise("wem-opus").alias("codec"), F.lit(1).alias("channels"), F.lit(48_000).alias("rate"), (F.col("p_retailprice") / 1000).alias("duration"),
        F.when(size == 13, "cut off").alias("error"),
    )
    copy = F.col("copy")
    later, kind = copy > 0, F.octet_length("p_name") % 7
    rows = part.select("*", F.explode(F.sequence(F.lit(0), key % 4)).alias("copy")).where(copy < key % 4)
    places = rows.select(
        key.alias("ident"), F.when(later & (kind == 0), copy).otherwise(0).alias("ident_high"), copy.alias("source_index"), (key % 100).alias("entry_index"), F.concat(F.lit("pack"), copy).alias("path"),
        F.when(later & (kind == 1), "wem-vorbis").otherwise("wem-opus").alias("codec"), F.lit(1).alias("channels"), F.lit(48_000).alias("rate"), (F.col("p_retailprice") / 1100 + F.when(later & (kind == 2), 0.5).otherwise(0.01 * copy / 2)).alias("duration"),
        F.lit(7).alias("trailer_kind"), F.lit(4).alias("companion_bytes"), F.sha2(F.when(later & (kind == 3), F.col("p_brand")).otherwise(F.lit("side")), 256).alias("companion_sha256"), F.when((kind == 4) & (copy == 1), "block size differs").alias("error"),
    )
    return new, places, part.where(size % 17 == 0).select(key.alias("ident"))


def mapping_states(spark: SparkSession, d: str) -> DataFrame:
    got = mapping.mapped(*_places(spark, d))
    return got.select("ident", "status", "rows", "entries", "differences", "problems", "detail", "path", F.round("delta_pct", 6).alias("delta_pct"))


_PLACED_SQL = """
WITH p AS (SELECT p_partkey AS ident, p_partkey % 4 AS n, strlen(p_name) % 7 AS kind, p_size, p_brand, p_retailprice / 1000 AS fresh, p_retailprice / 1100 AS known FROM part),
s AS (SELECT *, CASE WHEN p_size % 17 = 0 THEN 'ignorado' WHEN n = 0 THEN 'ausente' WHEN p_size = 13 OR kind = 4 AND n > 1 THEN 'erro' WHEN n > 1 AND kind IN (1, 2, 3) THEN 'duplicado_divergente' WHEN p_size % 11 = 0 THEN 'incompatível'
  WHEN n > 1 AND kind = 0 THEN 'id_high_expandido' WHEN n > 1 THEN 'duplicado_equivalente' ELSE 'ok' END AS status,
  CASE WHEN n <= 1 OR p_size % 17 = 0 THEN '' ELSE CASE kind WHEN 0 THEN 'id_high' WHEN 1 THEN 'codec' WHEN 2 THEN 'duração' WHEN 3 THEN 'conteúdo_CR2W' ELSE '' END END AS differences,
  CASE WHEN n > 1 AND kind = 0 THEN 0 ELSE n - 1 END AS pos FROM p)"""
MAPPED_SQL = f"""{_PLACED_SQL},
t AS (SELECT *, CASE WHEN status = 'incompatível' THEN 'codec wem-opus -> pcm; substituto não é WEM Opus: pcm' ELSE '' END AS problems,
  CASE WHEN n > 1 AND kind = 0 THEN n || ' chaves compostas preservadas' WHEN n > 1 THEN n || ' cópias equivalentes; selecionado pack' || pos END AS note, status IN ('ok', 'duplicado_equivalente', 'id_high_expandido', 'incompatível') AS shown FROM s)
SELECT ident, status, CASE WHEN status = 'ignorado' THEN 0 ELSE n END::BIGINT AS rows, CASE WHEN status = 'id_high_expandido' THEN n WHEN status IN ('ok', 'duplicado_equivalente') THEN 1 ELSE 0 END::BIGINT AS entries, differences, problems,
  CASE status WHEN 'ignorado' THEN 'omitido explicitamente' WHEN 'ausente' THEN 'ID não encontrado nos pacotes descobertos' WHEN 'erro' THEN CASE WHEN p_size = 13 THEN 'cut off' ELSE 'block size differs' END
    WHEN 'duplicado_divergente' THEN 'cópias divergentes em [' || differences || ']' ELSE concat_ws('; ', note, nullif(problems, '')) END AS detail,
  CASE WHEN shown THEN 'pack' || pos END AS path, CASE WHEN shown THEN round((fresh / (known + 0.01 * pos / 2) - 1) * 100, 6) END AS delta_pct
FROM t"""


def mapping_taken(spark: SparkSession, d: str) -> DataFrame:
    new, places, skipped = _places(spark, d)
    return mapping.taken(mapping.mapped(new, places, skipped), places)


TAKEN_SQL = f"""{_PLACED_SQL}
SELECT ident, CASE WHEN status = 'id_high_expandido' THEN c ELSE 0 END AS ident_high, c AS source_index, ident % 100 AS entry_index, 'pack' || c AS path
FROM s, range(3) r(c) WHERE status IN ('ok', 'duplicado_equivalente', 'id_high_expandido') AND c < n AND (status = 'id_high_expandido' OR c = n - 1)"""


def edit_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Documents with planted thanks, grouped, words and selves in their texts, through the whole cascade of edits."""
    key = F.col("doc_id")
    planted = F.when(key % 5 == 0, "Obrigado, disse o bruxo. ").when(key % 5 == 1, "Sou eu mesmo. Do bruxo? ").when(key % 5 == 2, "Estou cansado e OBRIGADO. ").when(key % 5 == 3, "Ele mesmo viu Um bruxo. ").otherwise("")
    lines = _t(spark, d, "documents").select(key.alias("ident"), F.concat(planted, F.substring("text", 1, 200), F.when(key % 4 == 0, " o mesmo").otherwise("")).alias("text"), F.when(key % 5 == 4, "termo").otherwise("").alias("flag"))
    pick = lambda r: lines.where(F.col("ident") % 5 == r).select("ident")
    words = pick(2).select("ident", F.lit(1).alias("seq"), F.lit("cansado").alias("old"), F.lit("cansada").alias("new"))
    phrases = pick(3).select("ident", F.lit(1).alias("seq"), F.lit("Ele mesmo").alias("old"), F.lit("Ela mesma").alias("new"))
    rules = P.cascade_rules(lines, "ident", pick(0).union(pick(1)), words, pick(1), phrases)
    empty = spark.createDataFrame([], "ident long, reason string")
    return prepare.gender_decisions(lines, rules, empty, empty).select("ident", "classification", "final", "reason")


CASCADE_EDITS_SQL = """
WITH l AS (SELECT doc_id AS ident, doc_id % 5 AS r, left(text, 200) || CASE WHEN doc_id % 4 = 0 THEN ' o mesmo' ELSE '' END AS rest FROM documents),
e AS (SELECT *, CASE r WHEN 0 THEN 'Obrigada, disse a bruxa. ' || rest WHEN 1 THEN 'Sou eu mesma. Da bruxa? ' || regexp_replace(rest, '\\bmesmo\\b', 'mesma', 'g') WHEN 2 THEN 'Estou cansada e OBRIGADA. ' || rest WHEN 3 THEN 'Ela mesma viu Um bruxo. ' || rest ELSE rest END AS final,
  CASE r WHEN 0 THEN 'obrigado→obrigada; bruxo→bruxa (autorreferência)' WHEN 1 THEN 'bruxo→bruxa (autorreferência); mesmo→mesma (autorreferência)' WHEN 2 THEN 'obrigado→obrigada; cansado→cansada' WHEN 3 THEN 'Ele mesmo→Ela mesma' END AS notes FROM l)
SELECT ident, CASE WHEN r = 4 THEN 'aprovado_sem_alteracao' ELSE 'corrigido' END AS classification, final,
  CASE WHEN r = 4 THEN 'Aprovado sem alteração: termo não se refere à personagem jogável.' ELSE 'Concordância feminina da personagem jogável: ' || notes || '.' END AS reason FROM e"""


QUERIES = {
    "id_only_lines": id_only_lines, "comma_files": comma_files, "json_document": json_document, "variant_files": variant_files, "package_orders": package_orders, "refused_overwrite": refused_overwrite, "media_checks": media_checks,
    "unique_join": unique_join, "archive_changes": archive_changes, "required_files": required_files, "profile_counts": profile_counts, "repeated_assignments": repeated_assignments, "idset_overlaps": idset_overlaps,
    "mapping_states": mapping_states, "mapping_taken": mapping_taken, "edit_cascade": edit_cascade,
}
ORACLE_SQL = {
    "id_only_lines": ID_LINES_SQL, "comma_files": COMMAS_SQL, "json_document": JSON_DOCUMENT_SQL, "variant_files": VARIANTS_SQL, "package_orders": PACKAGES_SQL, "refused_overwrite": REFUSED_SQL, "media_checks": MEDIA_SQL,
    "unique_join": UNIQUE_SQL, "archive_changes": CHANGES_SQL, "required_files": REQUIRED_SQL, "profile_counts": PROFILES_SQL, "repeated_assignments": REPEATED_SQL, "idset_overlaps": OVERLAPS_SQL,
    "mapping_states": MAPPED_SQL, "mapping_taken": TAKEN_SQL, "edit_cascade": CASCADE_EDITS_SQL,
}
