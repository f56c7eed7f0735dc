"""Reference resolution, relation catalog and value joins over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.operators import relations as R
from sheafwork.operators import walk
from sheafwork.plans.registry import query
from sheafwork.session import table

#: (from kind, its id columns, to kind, reference column); ``case`` has no rows anywhere, so nothing can be said of it.
REFERENCES = [
    ("lineitem", ["l_orderkey", "l_linenumber"], "orders", "l_orderkey"), ("lineitem", ["l_orderkey", "l_linenumber"], "part", "l_partkey"),
    ("lineitem", ["l_orderkey", "l_linenumber"], "supplier", "l_suppkey"), ("orders", ["o_orderkey"], "customer", "o_custkey"),
    ("customer", ["c_custkey"], "nation", "c_nationkey"), ("supplier", ["s_suppkey"], "nation", "s_nationkey"), ("nation", ["n_nationkey"], "region", "n_regionkey"),
    ("events", ["event_id"], "customer", "user_id"), ("labels", ["doc_id"], "documents", "doc_id"), ("part", ["p_partkey"], "nation", "p_size"), ("conversations", ["conv_id", "turn"], "case", "conv_id"),
]
KINDS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "events": "event_id", "documents": "doc_id"}


def ids_of(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [tables[k].select(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id")) for k, c in KINDS.items()])


def refs_of(tables: dict[str, DataFrame]) -> DataFrame:
    """All references; a table with several is scanned once."""
    kinds = list(dict.fromkeys(k for k, *_ in REFERENCES))
    return reduce(DataFrame.unionByName, [R.all_references(tables[k], k, F.concat_ws("/", *next(ids for x, ids, *_ in REFERENCES if x == k)), [(to, c) for x, _, to, c in REFERENCES if x == k]) for k in kinds])


def verdicts_of(tables: dict[str, DataFrame]) -> DataFrame:
    """All references with their verdicts, added up by column; those to a kind meet its ids in one aggregate."""
    kinds = list(dict.fromkeys(to for *_, to, _ in REFERENCES))
    known = {k: (tables[k], c) for k, c in KINDS.items()}
    return reduce(DataFrame.unionByName, [R.target_verdicts(k, [(x, tables[x], c) for x, _, to, c in REFERENCES if to == k], known.get(k)) for k in kinds])


def sources_of(tables: dict[str, DataFrame]) -> DataFrame:
    """How many different ids refer to each kind."""
    kinds = {k: ids for k, ids, *_ in REFERENCES}
    return reduce(DataFrame.unionByName, [R.source_counts(tables[k], k, ids, [(to, c) for x, _, to, c in REFERENCES if x == k]) for k, ids in kinds.items()])


def tables_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Each table is opened once a query."""
    return {k: table(spark, d, k) for k in dict.fromkeys([*KINDS, *(k for k, *_ in REFERENCES)])}


def edges_of(spark: SparkSession, d: str) -> DataFrame:
    tables = tables_of(spark, d)
    return R.resolve(refs_of(tables), ids_of(tables)).select(*R.EDGE)


def catalog_of(spark: SparkSession, d: str) -> DataFrame:
    tables = tables_of(spark, d)
    return R.verdict_catalog(verdicts_of(tables), sources_of(tables))


_IDS_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, CAST({c} AS VARCHAR) AS id FROM {k}" for k, c in KINDS.items())
_REFS_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS from_kind, '{to}' AS to_kind, concat_ws('/', {', '.join(ids)}) AS from_id, CAST({c} AS VARCHAR) AS to_id, '{c}' AS \"column\", 'hard' AS mechanism FROM {k} WHERE {c} IS NOT NULL"
    for k, ids, to, c in REFERENCES
)
_EDGES_SQL = f"""
ids AS (SELECT DISTINCT kind, id FROM ({_IDS_SQL}) WHERE id IS NOT NULL),
refs AS ({_REFS_SQL}),
edges AS (
  SELECT r.*, CASE WHEN k.kind IS NULL THEN NULL ELSE i.id IS NOT NULL END AS valid
  FROM refs r LEFT JOIN ids i ON i.kind = r.to_kind AND i.id = r.to_id LEFT JOIN (SELECT DISTINCT kind FROM ids) k ON k.kind = r.to_kind)"""
_CATALOG_SQL = f"""{_EDGES_SQL},
counts AS (
  SELECT from_kind, to_kind, count(*) AS edges, count(DISTINCT from_id) AS from_ids, count(DISTINCT to_id) AS to_ids,
    string_agg(DISTINCT "column", ',' ORDER BY "column") AS join_keys, string_agg(DISTINCT mechanism, ',' ORDER BY mechanism) AS mechanisms,
    count(*) FILTER (WHERE valid) AS valid_true, count(*) FILTER (WHERE NOT valid) AS valid_false, count(*) FILTER (WHERE valid IS NULL) AS valid_null
  FROM edges GROUP BY from_kind, to_kind),
catalog AS (
  SELECT *, CASE WHEN from_ids = edges AND to_ids = edges THEN '1:1' WHEN from_ids = edges THEN 'many:1' WHEN to_ids = edges THEN '1:many' ELSE 'many:many' END AS cardinality
  FROM counts)"""


@query(f"WITH {_EDGES_SQL} SELECT from_kind, to_kind, \"column\", coalesce(CAST(valid AS VARCHAR), 'unknown') AS valid, count(*) AS edges FROM edges GROUP BY ALL")
def fk_resolve_valid(spark: SparkSession, d: str) -> DataFrame:
    """Every reference of every table with its three-valued verdict, counted."""
    verdicts = {"true": "valid_true", "false": "valid_false", "unknown": "valid_null"}
    each = F.inline(F.array(*[F.struct(F.lit(v).alias("valid"), F.col(c).alias("edges")) for v, c in verdicts.items()]))
    return verdicts_of(tables_of(spark, d)).select("from_kind", "to_kind", "column", each).where("edges > 0")


@query(f"WITH {_CATALOG_SQL} SELECT * FROM catalog")
def pair_catalog(spark: SparkSession, d: str) -> DataFrame:
    return catalog_of(spark, d)


@query(f"""WITH {_CATALOG_SQL},
kinds AS (SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'labels', 'conversations', 'case']) AS kind),
dirs AS (
  SELECT x.kind AS a, y.kind AS b, side, CASE side WHEN 'ab' THEN x.kind ELSE y.kind END AS from_kind, CASE side WHEN 'ab' THEN y.kind ELSE x.kind END AS to_kind
  FROM kinds x JOIN kinds y ON x.kind < y.kind, (SELECT unnest(['ab', 'ba']) AS side)),
st AS (
  SELECT a, b, side, coalesce(edges, 0) AS edges, coalesce(cardinality, '-') AS cardinality,
    CASE WHEN edges IS NULL THEN CASE WHEN from_kind IN ('case', 'region') THEN 'ledgered' ELSE 'missing' END WHEN valid_false > 0 THEN 'partial' ELSE 'modeled' END AS status
  FROM dirs LEFT JOIN catalog USING (from_kind, to_kind))
SELECT a, b, side, status, edges, cardinality,
  CASE status WHEN 'partial' THEN 'resolve dangling' WHEN 'missing' THEN 'find a carrier' WHEN 'ledgered' THEN 'no reference column' END AS unblock FROM st""")
def direction_ladder(spark: SparkSession, d: str) -> DataFrame:
    """All directions between the kinds with their status; kinds without any reference column are in the ledger."""
    kinds = spark.createDataFrame([(k,) for k in [*KINDS, "lineitem", "labels", "conversations", "case"]], "kind string")
    ledger = kinds.where("kind IN ('case', 'region')").select(F.col("kind").alias("from_kind")).join(F.broadcast(kinds.select(F.col("kind").alias("to_kind"))), F.col("from_kind") != F.col("to_kind")).withColumn("reason", F.lit("no reference column"))
    return R.direction_ladder(kinds, catalog_of(spark, d), ledger)


@query(f"""WITH {_CATALOG_SQL} SELECT least(from_kind, to_kind) AS a, greatest(from_kind, to_kind) AS b, CAST(sum(edges) AS BIGINT) AS edges, count(*) AS directions FROM catalog GROUP BY 1, 2""")
def unordered_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The catalog by unordered pair: either direction has the same key."""
    c = catalog_of(spark, d)
    return c.groupBy(F.least("from_kind", "to_kind").alias("a"), F.greatest("from_kind", "to_kind").alias("b")).agg(F.sum("edges").alias("edges"), F.count("*").alias("directions"))


@query(f"""WITH {_CATALOG_SQL} SELECT count(*) AS pairs, CAST(sum(edges) AS BIGINT) AS edges, CAST(sum(valid_true) AS BIGINT) AS valid_true, CAST(sum(valid_false) AS BIGINT) AS valid_false,
  CAST(sum(valid_null) AS BIGINT) AS valid_null, CAST(sum(valid_true) + sum(valid_false) + sum(valid_null) AS BIGINT) = CAST(sum(edges) AS BIGINT) AS closes FROM catalog""")
def matrix_totals(spark: SparkSession, d: str) -> DataFrame:
    c = catalog_of(spark, d).agg(F.count("*").alias("pairs"), *[F.sum(x).alias(x) for x in ("edges", "valid_true", "valid_false", "valid_null")])
    return c.withColumn("closes", F.col("valid_true") + F.col("valid_false") + F.col("valid_null") == F.col("edges"))


@query(f"""WITH {_EDGES_SQL} SELECT from_kind, to_kind, to_id, count(*) AS dangling FROM edges WHERE valid = FALSE GROUP BY ALL""")
def dangling_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Every end that no target has."""
    return edges_of(spark, d).where(~F.col("valid")).groupBy("from_kind", "to_kind", "to_id").agg(F.count("*").alias("dangling"))


@query("""WITH late AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS id FROM conversations WHERE role = 'user')
SELECT 'conversations' AS from_kind, l.id IS NOT NULL AS valid, count(*) AS edges FROM conversations c LEFT JOIN late l ON l.id = CAST(c.conv_id AS VARCHAR) WHERE conv_id IS NOT NULL GROUP BY ALL""")
def late_validity(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts that were null are given once the target's ids come in."""
    edges = edges_of(spark, d).where("to_kind = 'case'")
    late = table(spark, d, "conversations").where("role = 'user'").select(F.lit("case").alias("kind"), F.col("conv_id").cast("string").alias("id"))
    return R.revalidate(edges, late).groupBy("from_kind", "valid").agg(F.count("*").alias("edges"))


@query("""SELECT event_type, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS evidence FROM
(SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn <= 3 GROUP BY event_type""")
def first_k_evidence(spark: SparkSession, d: str) -> DataFrame:
    return R.first_k(table(spark, d, "events"), ["event_type"], [F.col("event_id")], 3, "event_id")


@query("""WITH c AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS v FROM events WHERE props IS NOT NULL)
SELECT CAST(event_id AS VARCHAR) AS from_id, 'part' AS to_kind, v AS to_id FROM c JOIN (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id FROM part) ON id = v""")
def json_path_join(spark: SparkSession, d: str) -> DataFrame:
    """References inside JSON payloads, by a declared carrier path."""
    ev = table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), "props")
    cells = walk.walk_json(ev, ["id"], "props", depth=2).withColumn("kind", F.lit("event"))
    carriers = spark.createDataFrame([("event", "k", "part", "path:k")], "kind string, norm_path string, target string, method string")
    ids = table(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"))
    return R.carrier_edges(cells, carriers, ids)[0].select("from_id", "to_kind", "to_id")


@query("""SELECT path AS norm_path, count(*) AS cells, count(DISTINCT v) AS "values" FROM (SELECT 'k' AS path, json_extract_string(props, '$.k') AS v FROM events) WHERE v IS NOT NULL GROUP BY path""")
def payload_census(spark: SparkSession, d: str) -> DataFrame:
    """Which generic paths payloads have, declared or not."""
    cells = walk.walk_json(table(spark, d, "events"), ["event_id"], "props", depth=2)
    return cells.groupBy("norm_path").agg(F.count("*").alias("cells"), F.count_distinct("value").alias("values"))


@query("""WITH c AS (
  SELECT 'orders' AS kind, 'o_custkey' AS norm_path, CAST(o_custkey AS VARCHAR) AS value FROM orders UNION ALL SELECT 'lineitem', 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'customer', 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT 'nation', 'n_regionkey', CAST(n_regionkey AS VARCHAR) FROM nation),
i AS (SELECT DISTINCT * FROM (SELECT 'customer' AS target, CAST(c_custkey AS VARCHAR) AS value FROM customer UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR) FROM region UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR) FROM nation)),
p AS (SELECT kind, target, norm_path, count(*) AS hits, count(DISTINCT c.value) AS "values" FROM c JOIN i ON c.value = i.value WHERE kind <> target AND NOT (kind = 'orders' AND norm_path = 'o_custkey') GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY kind, target ORDER BY hits DESC, norm_path) AS rank FROM p QUALIFY rank <= 3""")
def residual_value_join(spark: SparkSession, d: str) -> DataFrame:
    """What exact values suggest beyond the pinned reference of orders: one equi join of all values with all ids."""
    cell = lambda k, c: table(spark, d, k).select(F.lit(k).alias("kind"), F.lit(c).alias("norm_path"), F.col(c).cast("string").alias("value"))
    cells = reduce(DataFrame.unionByName, [cell("orders", "o_custkey"), cell("lineitem", "l_suppkey"), cell("customer", "c_mktsegment"), cell("nation", "n_regionkey")])
    ids = ids_of(tables_of(spark, d)).where("kind IN ('customer', 'supplier', 'region', 'nation')")
    pinned = spark.createDataFrame([("orders", "o_custkey")], "kind string, norm_path string")
    return R.residual_values(cells, ids, pinned).withColumn("rank", F.col("rank").cast("bigint"))


@query(r"""WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS token FROM documents)
SELECT n_name, count(*) AS hits, count(DISTINCT doc_id) AS docs FROM t JOIN nation ON token = lower(n_name) GROUP BY n_name""")
def token_enum_join(spark: SparkSession, d: str) -> DataFrame:
    """Words of texts that name a member of an enumeration, case apart."""
    words = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("token"))
    names = table(spark, d, "nation").select("n_name", F.lower("n_name").alias("low"))
    return words.join(F.broadcast(names), F.lower("token") == F.col("low")).groupBy("n_name").agg(F.count("*").alias("hits"), F.count_distinct("doc_id").alias("docs"))


@query("""SELECT token, count(*) AS parts, CAST(min(p_partkey) AS BIGINT) AS first_part FROM part JOIN (SELECT unnest(['STEEL', 'brass', 'ECONOMY', 'green', '1']) AS token) ON contains(lower(concat_ws(' ', p_name, p_type, p_brand)), lower(token)) GROUP BY token""")
def substring_token_join(spark: SparkSession, d: str) -> DataFrame:
    """Tokens anywhere in a part's texts: a theta join with a small broadcast side."""
    rows = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("hay"))
    tokens = spark.createDataFrame([("STEEL",), ("brass",), ("ECONOMY",), ("green",), ("1",)], "token string")
    return R.substring_matches(rows, "hay", tokens, "token").groupBy("token").agg(F.count("*").alias("parts"), F.min("p_partkey").alias("first_part"))


@query(r"""WITH w AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM benchmark),
pool AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents),
c AS (SELECT item_id, count(*) AS tokens, count(pool.token) AS found FROM w LEFT JOIN pool USING (token) GROUP BY item_id)
SELECT item_id, tokens, found, CASE WHEN found = tokens THEN 'confirmed' WHEN found > 0 THEN 'partial' ELSE 'pending' END AS status FROM c""")
def token_confirmation(spark: SparkSession, d: str) -> DataFrame:
    """How many of an item's words the pool of all documents has."""
    cut = lambda t, *k: table(spark, d, t).select(*k, F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token")).distinct()
    pool = cut("documents").withColumn("_p", F.lit(1))
    c = cut("benchmark", "item_id").join(pool, "token", "left").groupBy("item_id").agg(F.count("*").alias("tokens"), F.count("_p").alias("found"))
    return c.withColumn("status", F.when(F.col("found") == F.col("tokens"), "confirmed").when(F.col("found") > 0, "partial").otherwise("pending"))


@query("""SELECT doc_id, coalesce(quality, -1) AS quality, CAST(NULL AS VARCHAR) AS lang FROM labels UNION ALL SELECT doc_id, -1, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Labels, and stubs for the documents that have none."""
    return R.anti_fallback(table(spark, d, "labels").select("doc_id", "quality"), table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"]).select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), "lang")


@query("""SELECT l_orderkey, l_linenumber, coalesce(s_name, p_name, CAST(l_suppkey AS VARCHAR)) AS name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_suppkey""")
def name_resolution(spark: SparkSession, d: str) -> DataFrame:
    """A name by the first of several tables that has the key, else the key itself."""
    keys = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return R.name_lookup(keys, "l_suppkey", (table(spark, d, "supplier"), "s_suppkey", "s_name"), (table(spark, d, "part"), "p_partkey", "p_name")).drop("l_suppkey")


@query("""WITH m AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL) SELECT p_type, p_brand, n, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS rank FROM m QUALIFY rank <= 3""")
def top_paths_per_direction(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("p_type").orderBy(F.desc("n"), "p_brand"))
    return n.withColumn("rank", rank.cast("bigint")).where("rank <= 3")


@query("""SELECT n_name, count(*) AS customers, string_agg(c_name, ',' ORDER BY c_name) AS names FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name""")
def collected_children(spark: SparkSession, d: str) -> DataFrame:
    """One to many, collected in order."""
    j = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count("*").alias("customers"), F.array_join(F.sort_array(F.collect_list("c_name")), ",").alias("names"))


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM documents), s AS (SELECT doc_id, CASE WHEN length(w) > 6 THEN 'Part' ELSE 'Nation' END AS prefix, CAST(length(w) AS VARCHAR) AS to_id FROM t)
SELECT CASE prefix WHEN 'Part' THEN 'part' ELSE 'nation' END AS to_kind, CASE WHEN k.id IS NOT NULL THEN 'true' ELSE 'false' END AS valid, count(*) AS refs
FROM s LEFT JOIN (SELECT 'part' AS kind, CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey > 8 UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey > 2) k ON k.kind = CASE prefix WHEN 'Part' THEN 'part' ELSE 'nation' END AND k.id = s.to_id GROUP BY ALL""")
def script_token_references(spark: SparkSession, d: str) -> DataFrame:
    """Tokens like Part.9 (made of each word's length) resolved by their prefix; some ends are taken away."""
    docs = table(spark, d, "documents")
    script = F.array_join(F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.concat(F.when(F.length(w) > 6, "Part.").otherwise("Nation."), F.length(w).cast("string"))), " ")
    ids = table(spark, d, "part").where("p_partkey > 8").select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"))
    ids = ids.unionByName(table(spark, d, "nation").where("n_nationkey > 2").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("string").alias("id")))
    prefixes = spark.createDataFrame([("Part", "part"), ("Nation", "nation")], "prefix string, kind string")
    found = R.token_reference_counts(docs.select("doc_id", script.alias("script")), "doc_id", "script", r"[A-Z][a-z]+\.\d+", prefixes, ids)
    return found.select("to_kind", F.col("valid").cast("string").alias("valid"), "refs")


@query("""SELECT c_custkey, 'c_mktsegment' AS "column", c_mktsegment AS name FROM customer WHERE lower(trim(c_mktsegment)) IN ('building', 'none')""")
def banned_name_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Names that may not be published."""
    banned = spark.createDataFrame([(" Building ",), ("none",)], "name string")
    return R.banned_names(table(spark, d, "customer"), ["c_custkey"], ["c_mktsegment"], banned)


@query("""SELECT o_orderkey AS id, CAST(f AS INT) AS field, n_name AS value FROM (SELECT o_orderkey, unnest([0, 1]) AS f, unnest([o_custkey % 30, o_orderkey % 30]) AS i FROM orders) LEFT JOIN nation ON n_nationkey = i""")
def constant_materialisation(spark: SparkSession, d: str) -> DataFrame:
    """Fields by their place in a pool that lacks the last places."""
    o = table(spark, d, "orders").select("o_orderkey", F.array(F.col("o_custkey") % 30, F.col("o_orderkey") % 30).alias("fields"))
    return R.constants_of(o, "o_orderkey", "fields", table(spark, d, "nation").select(F.col("n_nationkey").alias("index"), F.col("n_name").alias("value")))


@query("""SELECT side, count(*) AS n FROM (SELECT CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side
FROM (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_linenumber < 4) a FULL JOIN (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_quantity > 20) b ON a.k = b.k AND a.n = b.n) GROUP BY side""")
def positional_alignment(spark: SparkSession, d: str) -> DataFrame:
    """The n-th line of one plane beside the n-th of another."""
    li = table(spark, d, "lineitem")
    a, b = li.where("l_linenumber < 4").select("l_orderkey", "l_linenumber"), li.where("l_quantity > 20").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.aligned(a, b, ["l_orderkey"], "l_linenumber").groupBy("side").agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority, count(DISTINCT o_orderkey) AS entities, count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS bridged, count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS absent,
  count(DISTINCT o_orderkey) - count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus = 'F') - count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS off FROM orders GROUP BY 1""")
def drift_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Entities that neither of two states accounts for."""
    o = table(spark, d, "orders")
    return R.drift(o, o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_orderpriority"], "o_orderkey")
