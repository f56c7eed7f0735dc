"""Censuses, availability, agreement and fits over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.operators import aggregates as A
from sheafwork.operators import locale as L
from sheafwork.plans.registry import query
from sheafwork.session import table

LANGS = ["de", "en", "es", "fr"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "pages", "conversations", "benchmark"]


@query("SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'TOTAL' ELSE c_mktsegment END AS c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer GROUP BY ROLLUP (c_mktsegment)")
def group_totals_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return A.totals_with_grand(table(spark, d, "customer"), "c_mktsegment", n=F.count("*"), bal=F.round(F.sum("c_acctbal"), 2))


@query("SELECT n AS off FROM (SELECT 1 AS n) WHERE FALSE")
def unreconciled_totals(spark: SparkSession, d: str) -> DataFrame:
    """Subtotals against the grand total: no row says that they agree."""
    t = A.totals_with_grand(table(spark, d, "customer"), "c_mktsegment", n=F.count("*"))
    return A.unreconciled(t, "c_mktsegment", ["n"]).select(F.col("n").cast("int").alias("off"))


@query("SELECT p_brand, p_type, count(*) AS parts, max(p_size) AS max_size FROM part GROUP BY ROLLUP (p_brand, p_type)")
def package_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").rollup("p_brand", "p_type").agg(F.count("*").alias("parts"), F.max("p_size").alias("max_size"))


@query("SELECT event_type, n, CAST(weight AS DOUBLE) AS weight, round(weight / sum(weight) OVER (), 6) AS share FROM (SELECT event_type, count(*) AS n, round(sum(value), 2) AS weight FROM events GROUP BY 1)")
def weighted_histogram(spark: SparkSession, d: str) -> DataFrame:
    h = A.histogram(table(spark, d, "events"), "event_type", weight=F.col("value"))
    return h.select("event_type", "n", F.round("weight", 2).alias("weight"), F.round("share", 6).alias("share"))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1")
def state_pivot(spark: SparkSession, d: str) -> DataFrame:
    return A.state_counts(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@query("""SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS available, coalesce(string_agg(DISTINCT lang, ',' ORDER BY lang) FILTER (WHERE n_chars > 8000), '') AS named FROM documents GROUP BY source""")
def availability_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Where each source is available, and where it has a long text."""
    a = A.availability(table(spark, d, "documents"), ["source"], "lang", F.col("n_chars") > 8000)
    return a.select("source", F.array_join("available", ",").alias("available"), F.array_join("named", ",").alias("named"))


@query("""SELECT l_suppkey, count(DISTINCT l_returnflag) AS locales, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS "where" FROM lineitem WHERE l_quantity >= 50 GROUP BY 1 HAVING count(DISTINCT l_returnflag) < 3""")
def filler_census(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers whose largest lines have some but not all return flags."""
    return A.fillers(table(spark, d, "lineitem").where("l_quantity >= 50"), ["l_suppkey"], "l_returnflag", 3)


@query("""WITH own AS (SELECT source AS key, lang, bool_or(n_chars > 5000) AS f FROM documents GROUP BY ALL), base AS (SELECT key FROM own WHERE lang = 'en')
SELECT lang, count(*) AS keys, count(*) FILTER (WHERE f) AS filled, (SELECT count(*) FROM base) - count(b.key) AS missing, count(*) FILTER (WHERE b.key IS NULL) AS extra FROM own LEFT JOIN base b USING (key) GROUP BY lang""")
def coverage_vs_pivot(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "documents").select(F.col("source").alias("key"), "lang", "n_chars")
    return A.coverage(k, "key", "lang", "en", F.col("n_chars") > 5000)


@query("""WITH x AS (SELECT source AS id, lang AS locale, count(*) AS n FROM documents GROUP BY ALL), s AS (SELECT id, l.locale, CASE WHEN n IS NULL THEN 'missing' WHEN n < 4 THEN 'empty' ELSE 'ok' END AS state
FROM (SELECT DISTINCT id FROM x) CROSS JOIN (SELECT unnest(['de', 'en', 'es', 'fr']) AS locale) l LEFT JOIN x USING (id, locale))
SELECT 'source' AS kind, locale, count(*) FILTER (WHERE state = 'ok') AS n_ok, count(*) FILTER (WHERE state = 'empty') AS n_empty, count(*) FILTER (WHERE state = 'missing') AS n_missing FROM s GROUP BY locale""")
def text_key_states(spark: SparkSession, d: str) -> DataFrame:
    """Each source as a text key: its cell in every language is ok, empty (fewer than four documents) or missing."""
    docs = table(spark, d, "documents")
    leaves = docs.groupBy(F.col("lang").alias("locale"), F.col("source").alias("row")).agg(F.count("*").alias("n")).select("locale", F.lit("s").alias("sheet"), "row", F.lit("name").alias("path"), F.when(F.col("n") >= 4, F.col("n").cast("string")).otherwise("").alias("value"))
    refs = docs.select(F.lit("source").alias("kind"), F.col("source").alias("id"), F.lit("s").alias("sheet"), F.col("source").alias("row"), F.lit("name").alias("path"), F.lit("name").alias("template")).distinct()
    return L.cell_counts(L.resolve_text_keys(refs, leaves, LANGS))


@query("SELECT tp, fp, fn, tn, round(tp / (tp + fp + fn), 6) AS iou, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality <> 1 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic <> 0) AS fn, count(*) FILTER (WHERE quality <> 1 AND toxic <> 0) AS tn FROM labels)")
def confusion_iou(spark: SparkSession, d: str) -> DataFrame:
    c = A.confusion(table(spark, d, "labels"), F.col("quality") == 1, F.col("toxic") == 0)
    return c.withColumns({k: F.round(k, 6) for k in ("iou", "accuracy")})


@query("""SELECT CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang, count(*) AS n, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS rate, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) >= 0.8 AS pass FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang)""")
def agreement_by_group(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return A.agreement(j, "lang", F.col("quality") == 1, 0.8).withColumn("rate", F.round("rate", 6))


@query("SELECT lang, min(n_chars) AS low, round(median(n_chars), 6) AS mid, max(n_chars) AS high, round(avg(n_chars), 6) AS mean FROM documents GROUP BY lang")
def group_distances(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(F.min("n_chars").alias("low"), F.round(F.median("n_chars"), 6).alias("mid"), F.max("n_chars").alias("high"), F.round(F.avg("n_chars"), 6).alias("mean"))


@query("""WITH n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) SELECT source, lang AS majority, n AS votes FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn FROM n) WHERE rn = 1""")
def majority_label(spark: SparkSession, d: str) -> DataFrame:
    return A.majority(table(spark, d, "documents"), ["source"], "lang")


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, corr(l_quantity, l_extendedprice) >= 0.99 AS strong, round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 6) AS slope FROM lineitem GROUP BY 1")
def corr_gate(spark: SparkSession, d: str) -> DataFrame:
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.corr(q, p), 6).alias("r"), (F.corr(q, p) >= 0.99).alias("strong"), F.round(A.slope_through_origin(q, p), 6).alias("slope"))


@query("""SELECT CAST(n AS DOUBLE) AS n, round((xz * yy - yz * xy) / (xx * yy - xy * xy), 6) AS a, round((yz * xx - xz * xy) / (xx * yy - xy * xy), 6) AS b,
  round(mz - (xz * yy - yz * xy) / (xx * yy - xy * xy) * mx - (yz * xx - xz * xy) / (xx * yy - xy * xy) * my, 2) AS c
FROM (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS my, avg(l_extendedprice) AS mz, covar_pop(l_quantity, l_quantity) AS xx, covar_pop(l_discount, l_discount) AS yy,
  covar_pop(l_quantity, l_discount) AS xy, covar_pop(l_quantity, l_extendedprice) AS xz, covar_pop(l_discount, l_extendedprice) AS yz FROM lineitem)""")
def affine_fit(spark: SparkSession, d: str) -> DataFrame:
    f = A.affine_fit(table(spark, d, "lineitem"), "l_quantity", "l_discount", "l_extendedprice")
    return f.select("n", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"), F.round("c", 2).alias("c"))


@query("SELECT sheet, count(*) AS \"rows\" FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS sheet FROM {t}" for t in TABLES) + ") GROUP BY sheet")
def sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table in one plan."""
    return reduce(DataFrame.unionByName, [table(spark, d, t).select(F.lit(t).alias("sheet")) for t in TABLES]).groupBy("sheet").agg(F.count("*").alias("rows"))


@query("""WITH c AS (SELECT 'customer' AS sheet, c_custkey AS ord, unnest(['c_name', 'c_acctbal', 'c_mktsegment']) AS name, unnest([c_name, CAST(c_acctbal AS VARCHAR), CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END]) AS value FROM customer)
SELECT sheet, count(DISTINCT ord) AS "rows", CAST(3 AS BIGINT) AS cols, count(DISTINCT ord) * 3 AS grid, count(value) AS populated, 'orders' AS referenced_by FROM c GROUP BY sheet
UNION ALL SELECT 'orders', CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), ''""")
def schema_census(spark: SparkSession, d: str) -> DataFrame:
    """Rows, columns, grid and populated cells of a sheet, and who refers to it."""
    dictionary = spark.createDataFrame([("customer", "c_name", "1", None), ("customer", "c_acctbal", "4", None), ("customer", "c_mktsegment", "5", "A,B"), ("orders", "o_custkey", "6", "customer")], "sheet string, name string, code string, param string")
    c = table(spark, d, "customer").select(F.lit("customer").alias("sheet"), F.col("c_custkey").alias("ord"), "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    return A.sheet_census(dictionary, c.select("sheet", "ord"), c.unpivot(["sheet", "ord"], ["c_name", "c_acctbal", "c_mktsegment"], "name", "value"))


@query("SELECT event_type, round(avg(CASE WHEN abs(value - 50) < 5 THEN 1.0 ELSE 0.0 END), 6) AS plateau FROM events GROUP BY 1")
def plateau_fraction(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg((F.abs(F.col("value") - 50) < 5).cast("double")), 6).alias("plateau"))


@query("SELECT CAST(floor(n_chars / 1000) AS BIGINT) AS bin, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, bin LIMIT 8")
def column_density(spark: SparkSession, d: str) -> DataFrame:
    """The eight fullest bins (a top-k report)."""
    return table(spark, d, "documents").groupBy(F.floor(F.col("n_chars") / 1000).cast("bigint").alias("bin")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bin").limit(8)


@query("SELECT role, count(*) AS n, count(*) FILTER (WHERE length(text) >= 100) AS ok FROM conversations GROUP BY role")
def role_audit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.length("text") >= 100).alias("ok"))


@query("""SELECT locale, count(*) AS "rows", sha256(string_agg(id, chr(10) ORDER BY id)) AS ids_sha256 FROM (SELECT lang AS locale, 'doc/' || CAST(doc_id AS VARCHAR) AS id FROM documents) GROUP BY locale""")
def id_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each language and a digest of its ordered ids."""
    from sheafwork.operators.search import ordered_manifest

    return ordered_manifest(table(spark, d, "documents").select(F.col("lang").alias("locale"), F.lit("doc").alias("kind"), F.col("doc_id").cast("string").alias("id")))


@query("""SELECT CAST(-count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS INT) AS off FROM customer""")
def unreconciled_planted(spark: SparkSession, d: str) -> DataFrame:
    """Subtotals that lack a segment, against the grand total."""
    t = A.totals_with_grand(table(spark, d, "customer"), "c_mktsegment", n=F.count("*")).where("c_mktsegment <> 'BUILDING'")
    return A.unreconciled(t, "c_mktsegment", ["n"]).select(F.col("n").cast("int").alias("off"))
