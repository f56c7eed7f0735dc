"""Decoding, normalisation, search and publication over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.functions import decode as D
from sheafwork.functions import formulas
from sheafwork.functions import text as T
from sheafwork.operators import search as S
from sheafwork.plans.registry import query
from sheafwork.session import table

CASES = ["fire", "ice", "iron", "wood", "gold", "silk"]


@query("""SELECT p_partkey, ['S', 'M', 'L', 'XL'][CAST(p_size % 5 AS BIGINT) + 1] AS size_case, array_to_string(list_filter(list_transform(['fire', 'ice', 'iron', 'wood', 'gold', 'silk'], lambda c, i: CASE WHEN (CAST(p_size AS INT) >> CAST(i - 1 AS INT)) & 1 = 1 THEN c END), lambda x: x IS NOT NULL), ',') AS flags FROM part""")
def enum_and_flags_decode(spark: SparkSession, d: str) -> DataFrame:
    """Enum cases by index (null out of range), flag names by bit."""
    p = table(spark, d, "part")
    cases, flags = F.array(*map(F.lit, ("S", "M", "L", "XL"))), F.array(*map(F.lit, CASES))
    return p.select("p_partkey", D.enum_case(cases, F.col("p_size") % 5).alias("size_case"), F.array_join(D.flag_names(flags, F.col("p_size")), ",").alias("flags"))


@query(r"""SELECT class, coalesce(x, -1) AS x, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(url, '/(-?[0-9]+)(\.html)$') THEN 'html' WHEN regexp_matches(url, '/([a-z]{2})/(-?[0-9]+)') THEN 'page' ELSE 'other' END AS class,
  CASE WHEN regexp_matches(url, '/(-?[0-9]+)(\.html)$') THEN CAST(regexp_extract(url, '/(-?[0-9]+)(\.html)$', 1) AS INT) WHEN regexp_matches(url, '/([a-z]{2})/(-?[0-9]+)') THEN TRY_CAST(regexp_extract(url, '/([a-z]{2})/(-?[0-9]+)', 1) AS INT) END AS x FROM pages) GROUP BY ALL""")
def path_classify(spark: SparkSession, d: str) -> DataFrame:
    """Class and coordinates by patterns over paths."""
    t = D.tile_of(F.col("url"), {"html": r"/(-?[0-9]+)(\.html)$", "page": "/([a-z]{2})/(-?[0-9]+)"})
    return table(spark, d, "pages").select(t.alias("t")).select("t.class", F.coalesce("t.x", F.lit(-1)).alias("x")).groupBy("class", "x").agg(F.count("*").alias("n"))


@query(r"""WITH p AS (SELECT regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages), s AS (SELECT path, string_split(regexp_replace(path, '^/', ''), '/')[1] AS f FROM p),
r AS (SELECT f, CASE WHEN f IN ('en', 'de', 'fr', 'es') THEN regexp_replace(path, '^/[^/]*', '') ELSE path END AS rest FROM s)
SELECT CASE WHEN f = 'en' THEN 'redirect' WHEN CASE WHEN rest = '' THEN '/' ELSE rest END IN ('/', '/1', '/2') THEN 'live' ELSE '404' END AS verdict, CASE WHEN f IN ('en', 'de', 'fr', 'es') THEN f ELSE 'en' END AS locale, count(*) AS n FROM r GROUP BY ALL""")
def route_decision(spark: SparkSession, d: str) -> DataFrame:
    """Locale prefix and liveness of request paths."""
    path = F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)
    r = D.route(path, ["en", "de", "fr", "es"], ["/", "/1", "/2"])
    return table(spark, d, "pages").select(r.alias("r")).groupBy("r.verdict", "r.locale").agg(F.count("*").alias("n"))


@query(r"""SELECT page_id, CASE WHEN starts_with(ltrim(html), '<') THEN 'xml' ELSE 'u:' || lower(hex(encode(left(html, 4)))) END AS token FROM pages""")
def content_sniff(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", D.sniff(F.encode("html", "utf-8")).alias("token"))


_NORM_SQL = r"trim(regexp_replace(replace(lower(strip_accents(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\[[^\]]*\]', ' ', 'g'), '::[A-Za-z0-9_]+::', ' ', 'g'))), 'ł', 'l'), '[\s\x{0b}\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+', ' ', 'g'))"


@query(f"SELECT item_id, {_NORM_SQL} AS norm FROM benchmark")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    """The search form of all benchmark texts.  The SQL strips marks of letters, which is all that these texts have to decompose."""
    return table(spark, d, "benchmark").select("item_id", T.normalize_name(F.col("text")).alias("norm"))


@query()
def normalize_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """The search form of all benchmark texts, those that normalize_text leaves out too; DuckDB has no NFKD."""
    return table(spark, d, "benchmark").select("item_id", T.normalize_name(F.col("text")).alias("norm"))


@query()
def normalize_all(spark: SparkSession, d: str) -> DataFrame:
    """The search form of every document's whole text; DuckDB has no NFKD."""
    return table(spark, d, "documents").select("doc_id", T.normalize_name(F.col("text")).alias("norm"))


@query(r"""WITH n AS (SELECT p_partkey AS id, p_brand AS kind, trim(regexp_replace(lower(p_name), '\s+', ' ', 'g')) AS norm FROM part), q AS (SELECT unnest(['part', 'st', '12', 'blue']) AS q),
h AS (SELECT q, kind, id, norm, CASE WHEN norm = q THEN 1 WHEN starts_with(norm, q) OR contains(norm, ' ' || q) THEN 2 WHEN contains(norm, q) THEN 3 END AS tier FROM n, q WHERE contains(norm, q))
SELECT q, kind, id, tier, row_number() OVER (PARTITION BY q ORDER BY tier, length(norm), CASE kind WHEN 'Brand#11' THEN 1 WHEN 'Brand#12' THEN 2 ELSE 3 END, id) AS rank FROM h QUALIFY rank <= 20""")
def search_rank(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 hits (the feature) of several queries over part names."""
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("kind"), T.normalize_ascii(F.col("p_name")).alias("norm"))
    queries = spark.createDataFrame([("part",), ("st",), ("12",), ("blue",)], "q string")
    return S.search_all(rows, queries, ["Brand#11", "Brand#12"], 20).select("q", "kind", "id", "tier", "rank")


@query("""SELECT l.locale, 'nation' AS kind, CAST(n_nationkey AS VARCHAR) AS id, n_name || '@' || l.locale AS name, CASE WHEN l.locale = 'en' THEN '/nation/' || CAST(n_nationkey AS VARCHAR) ELSE '/' || l.locale || '/nation/' || CAST(n_nationkey AS VARCHAR) END AS href
FROM nation, (SELECT unnest(['en', 'de', 'fr']) AS locale) l WHERE NOT (l.locale = 'fr' AND n_regionkey = 0)""")
def index_emit(spark: SparkSession, d: str) -> DataFrame:
    """The published index: named locales joined with names."""
    n = table(spark, d, "nation")
    full, part = F.array(*map(F.lit, ("en", "de", "fr"))), F.array(*map(F.lit, ("en", "de")))
    avail = n.select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("string").alias("id"), F.when(F.col("n_regionkey") == 0, part).otherwise(full).alias("named"))
    over = n.select(F.explode(full).alias("locale"), F.lit("nation").alias("kind"), F.col("n_nationkey").cast("string").alias("id"), "n_name").withColumn("name", F.concat_ws("@", "n_name", "locale")).drop("n_name")
    return S.index_rows(avail, over, ["nation"])


@query("""SELECT class, count(*) AS n FROM (SELECT CASE WHEN n.id IS NULL THEN 'flag_without_name' ELSE 'name_without_flag' END AS class
FROM (SELECT doc_id AS id FROM labels WHERE quality = 1) f FULL JOIN (SELECT doc_id AS id FROM documents WHERE n_chars > 500) n ON f.id = n.id WHERE f.id IS NULL OR n.id IS NULL) GROUP BY class""")
def consistency_gate(spark: SparkSession, d: str) -> DataFrame:
    """Flags (good labels) without a name (a long text), and the other way round."""
    av = table(spark, d, "labels").where("quality = 1").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), F.array(F.lit("en")).alias("named"))
    ov = table(spark, d, "documents").where("n_chars > 500").select(F.lit("en").alias("locale"), F.lit("d").alias("kind"), F.col("doc_id").alias("id"), F.lit("x").alias("name"))
    return S.index_conflicts(av, ov).groupBy("class").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 + CASE WHEN l_linenumber = 7 THEN 0.2 ELSE power(greatest(l_quantity * 4.0 - 50, 0) / 120, 1.5) END), 6) AS local_price,
  CAST(ceil(l_partkey * CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 1.25 END / 20) * 20 AS BIGINT) AS next_xp, round(greatest(0.2, least(2.0, power(l_quantity / 20.0, 0.7))), 6) AS xp_ratio,
  round(100 + sqrt(greatest(0.0, least(1.0, (l_quantity / 50.0 - 0.1) / 0.4))) * -50, 6) AS capture_chance,
  CAST(greatest(least(l_linenumber * 12 + l_quantity, 80) - ceil(least(l_linenumber * 12 + l_quantity, 80) * (l_partkey % 100) / 100) - CASE WHEN l_linestatus = 'F' THEN 50 ELSE 0 END, 0) AS BIGINT) AS guard_left,
  CAST(10 + l_linenumber * 10 + CASE l_suppkey % 3 WHEN 1 THEN 20 WHEN 2 THEN 30 ELSE 0 END AS BIGINT) AS weapon_price, round((l_extendedprice * 2 + l_quantity * 3) / 1000 - 1, 6) AS craft_margin FROM lineitem""")
def price_curves(spark: SparkSession, d: str) -> DataFrame:
    """The rules over all lines, with their columns in the part of distance, level, health and guard."""
    c, q = F.col, F.col("l_quantity").cast("double")
    parts = F.array(F.struct(c("l_extendedprice").cast("double").alias("price"), F.lit(2).alias("count")), F.struct(q.alias("price"), F.lit(3).alias("count")))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(formulas.local_price(c("l_extendedprice").cast("double"), F.when(c("l_linenumber") != 7, q * 4.0), 120, 1.5), 6).alias("local_price"),
        formulas.next_level_xp(c("l_partkey"), F.when(c("l_returnflag") != "R", 1.25)).alias("next_xp"), F.round(formulas.xp_ratio(q / 20.0, 0.7), 6).alias("xp_ratio"),
        F.round(formulas.capture_chance(q / 50.0, 0.1, 0.5, 100, 50), 6).alias("capture_chance"),
        formulas.guard_left(c("l_linenumber") * 12, q, c("l_partkey") % 100, c("l_linestatus") == "F", 80, 50).alias("guard_left"),
        formulas.weapon_price(c("l_linenumber"), c("l_suppkey") % 3).cast("bigint").alias("weapon_price"), F.round(formulas.craft_margin(parts, F.lit(1000.0)), 6).alias("craft_margin"),
    )


@query("""SELECT o_orderkey, 'orders#' || CAST(o_orderkey AS VARCHAR) || ':status=''' || o_orderstatus || '''' AS locator, CAST(o_orderkey AS VARCHAR) AS id_back, o_orderstatus AS value_back FROM orders""")
def evidence_locator(spark: SparkSession, d: str) -> DataFrame:
    """Evidence locators and what they parse back to."""
    o = table(spark, d, "orders").select("o_orderkey", T.locator(F.lit("orders"), F.col("o_orderkey").cast("string"), F.lit("status"), F.col("o_orderstatus")).alias("locator"))
    return o.select("o_orderkey", "locator", T.parse_locator(F.col("locator"))["id"].alias("id_back"), T.parse_locator(F.col("locator"))["value"].alias("value_back"))


@query(r"""SELECT doc_id, CASE WHEN n_chars >= 1024 THEN format('{:,.1f}', n_chars / 1024.0) || ' KiB' ELSE CAST(n_chars AS VARCHAR) || ' B' END AS size FROM documents WHERE n_chars < 1048576""")
def human_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of all documents, null where n_chars is.  The SQL stops below 1 MiB; a test covers what lies above."""
    return table(spark, d, "documents").select("doc_id", T.human_size(F.col("n_chars")).alias("size"))


@query("""WITH h AS (SELECT doc_id, hex(encode(text)) AS h FROM documents), b AS (SELECT doc_id, length(h) // 2 AS n, list_transform(range(length(h) // 2), lambda i: CAST(('0x' || substr(h, 2 * i + 1, 2)) AS BIGINT)) AS b FROM h)
SELECT doc_id, CAST((n + coalesce(list_sum(list_transform(range(n), lambda i: (n - i) * b[i + 1])), 0)) % 65521 * 65536 + (1 + coalesce(list_sum(b), 0)) % 65521 AS BIGINT) AS adler FROM b""")
def adler_checksums(spark: SparkSession, d: str) -> DataFrame:
    """Adler-32 of every document's bytes; neither Spark nor DuckDB has it built in."""
    return table(spark, d, "documents").select("doc_id", D.adler32(F.encode("text", "utf-8")).alias("adler"))


@query(r"""SELECT doc_id, CASE WHEN n_chars >= 1073741824 THEN format('{:,.1f}', n_chars / 1073741824.0) || ' GiB' WHEN n_chars >= 1048576 THEN format('{:,.1f}', n_chars / 1048576.0) || ' MiB' WHEN n_chars >= 1024 THEN format('{:,.1f}', n_chars / 1024.0) || ' KiB' WHEN n_chars IS NOT NULL THEN CAST(n_chars AS VARCHAR) || ' B' END AS size
FROM (SELECT doc_id, n_chars FROM documents UNION ALL SELECT -1 - doc_id, n_chars * 4096 FROM documents UNION ALL SELECT NULL, NULL)""")
def human_sizes_all(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of all documents, of 4096 times as much, and of nothing."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    every = docs.unionByName(docs.select((-1 - F.col("doc_id")).alias("doc_id"), (F.col("n_chars") * 4096).alias("n_chars"))).unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("n_chars")))
    return every.select("doc_id", T.human_size(F.col("n_chars")).alias("size"))


@query(r"""WITH s AS (SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') AS t FROM pages) SELECT page_id, CAST(unnest(regexp_extract_all(t, 'href="(/[A-Za-z]+)"', 1)) AS VARCHAR) AS target FROM s""")
def uncommented_links(spark: SparkSession, d: str) -> DataFrame:
    """Links outside comments."""
    found = T.token_offsets(T.blank_spans(F.col("html"), "<!--.*?-->"), 'href="/[A-Za-z]+"')
    return table(spark, d, "pages").select("page_id", F.explode(found).alias("x")).select("page_id", F.regexp_extract("x.token", '"(.*)"', 1).alias("target"))


@query("""SELECT n_nationkey, replace('{count} in ' || n_name, '{count}', CAST(n_regionkey AS VARCHAR)) AS told, '/tiles/' || CAST(n_regionkey AS VARCHAR) || '/' || CAST(n_nationkey AS VARCHAR) || '/' || CAST(n_nationkey % 3 AS VARCHAR) || '.webp' AS url FROM nation""")
def url_and_count_templates(spark: SparkSession, d: str) -> DataFrame:
    """Templates filled in from columns."""
    n = table(spark, d, "nation")
    fill = {"z": F.col("n_regionkey"), "x": F.col("n_nationkey"), "y": F.col("n_nationkey") % 3}
    return n.select("n_nationkey", T.filled(F.concat(F.lit("{count} in "), "n_name"), count=F.col("n_regionkey")).alias("told"), T.filled(F.lit("/tiles/{z}/{x}/{y}.webp"), **fill).alias("url"))
