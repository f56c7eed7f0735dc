"""Binary and marked-up payloads made of the tables' bytes, with SQL that says the same of the same bytes."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.operators.types import type_display
from sheafwork.plans.registry import query
from sheafwork.session import dealt, fresh_folder, staged, table
from sheafwork.sources import binary, markup, terrain, textures


def texture_head(width: int, height: int, four: bytes = b"", bits: int = 0, masks: tuple[int, ...] = (0, 0, 0, 0)) -> bytes:
    """A texture's header."""
    flags = 0x4 if four else 0x41
    return b"DDS " + struct.pack("<IIIIIII44x", 124, 0x1007, height, width, 0, 0, 1) + struct.pack("<II4sI4I20x", 32, flags, four.ljust(4, b"\0"), bits, *masks)


_BYTE = "CAST(('0x' || substr({0}, 2 * ({1}) + 1, 2)) AS BIGINT)"


def _byte(text: str, k: object) -> str:
    return _BYTE.format(text, k)


_EXPAND = {"r": "((c >> 11) & 31) * 8 + (((c >> 11) & 31) >> 2)", "g": "((c >> 5) & 63) * 4 + (((c >> 5) & 63) >> 4)", "b": "(c & 31) * 8 + ((c & 31) >> 2)"}


def _channel(c: str) -> str:
    a, b = _EXPAND[c].replace("c ", "c0 "), _EXPAND[c].replace("c ", "c1 ")
    return f"CAST(sum(CASE i WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN CASE WHEN c0 > c1 THEN (2 * ({a}) + {b}) // 3 ELSE ({a} + {b}) // 2 END ELSE CASE WHEN c0 > c1 THEN ({a} + 2 * ({b})) // 3 ELSE 0 END END) AS BIGINT) AS {c}"


@query(f"""WITH m AS (SELECT p_partkey, md5(p_name) AS h FROM part WHERE p_partkey % 11 <> 0), x AS (SELECT p_partkey, substr(h, 1 + 16 * b, 16) AS x FROM m, (SELECT unnest([0, 1]) AS b)),
e AS (SELECT p_partkey, {_byte('x', 0)} + 256 * {_byte('x', 1)} AS c0, {_byte('x', 2)} + 256 * {_byte('x', 3)} AS c1, {_byte('x', 4)} + 256 * {_byte('x', 5)} + 65536 * {_byte('x', 6)} + 16777216 * {_byte('x', 7)} AS bits FROM x),
t AS (SELECT p_partkey, c0, c1, (bits >> (2 * k)) & 3 AS i FROM e, (SELECT unnest(range(16)) AS k))
SELECT p_partkey, {_channel('r')}, {_channel('g')}, {_channel('b')}, count(*) AS texels, CAST(NULL AS VARCHAR) AS problem FROM t GROUP BY p_partkey
UNION ALL SELECT p_partkey, NULL, NULL, NULL, 0, 'shorter than its texels' FROM part WHERE p_partkey % 11 = 0""")
def texture_texels(spark: SparkSession, d: str) -> DataFrame:
    """Block-compressed textures of 8 x 4 texels out of each part's digest, decoded; every eleventh is cut short."""
    k = F.col("p_partkey")
    whole = F.concat(F.lit(texture_head(8, 4, b"DXT1").hex()), F.md5(F.col("p_name").cast("binary")))
    files = dealt(table(spark, d, "part").select("p_partkey", "p_name")).select(k.cast("string").alias("path"), F.unhex(F.when(k % 11 == 0, F.substring(whole, 1, 280)).otherwise(whole)).alias("content"))
    images = staged(textures.decoded(files), "textures")  # decoded once for both uses
    sums = textures.texels(images).groupBy("path").agg(*[F.sum(c).alias(c) for c in "rgb"], F.count_if(F.col("a") == 255).alias("texels"))
    return images.select("path", "problem").join(sums, "path", "left").select(F.col("path").cast("bigint").alias("p_partkey"), "r", "g", "b", F.coalesce("texels", F.lit(0)).alias("texels"), "problem")


_FLOATS = [i * 0.5 - 2 for i in range(16)]
_H = "((c_custkey + j) % 16) * 0.5 - 2"
_N = {f"{c}_{k}": f"{f}({', '.join(_byte('h', 4 * p + i) for p in range(4))})" for i, c in enumerate("xyz") for k, f in (("low", "least"), ("high", "greatest"))}
_N |= {"seam": " + ".join(f"CASE WHEN {_byte('h', 4 * p + 3)} <> 0 THEN 1 ELSE 0 END" for p in range(4)), "seam_on_edge": " + ".join(f"CASE WHEN {_byte('h', 4 * p + 3)} <> 0 THEN 1 ELSE 0 END" for p in range(1, 4))}
_OFF = " + ".join(f"CASE WHEN {_byte('h', 4 * p + 3)} <> 255 THEN 1 ELSE 0 END" for p in range(4))
_I = {"layers": f"len(list_distinct([{', '.join(_byte('h', k) for k in range(16) if k % 4 != 3)}]))", "alpha_off": _OFF}
_W = {"over": " + ".join(f"CASE WHEN {' + '.join(_byte('h', 4 * p + c) for c in range(3))} > 255 THEN 1 ELSE 0 END" for p in range(4)), "alpha_off": _OFF}
_STATS = " UNION ALL ".join(f"SELECT c_custkey, '{name}' AS stat, CAST({e} AS DOUBLE) AS value FROM m WHERE c_custkey % 4 = {r}" for r, some in ((1, _N), (2, _I), (3, _W)) for name, e in some.items())


@query(f"""WITH m AS (SELECT c_custkey, md5(c_name) AS h FROM customer WHERE c_custkey % 13 <> 0), f AS (SELECT c_custkey, {_H} AS v FROM m, (SELECT unnest(range(4)) AS j) WHERE c_custkey % 4 = 0)
SELECT c_custkey, 2 AS side, stat, value FROM ({_STATS} UNION ALL SELECT c_custkey, 'low', CAST(min(v) AS DOUBLE) FROM f GROUP BY 1 UNION ALL SELECT c_custkey, 'high', CAST(max(v) AS DOUBLE) FROM f GROUP BY 1
UNION ALL SELECT c_custkey, 'sum', CAST(sum(v) AS DOUBLE) FROM f GROUP BY 1 UNION ALL SELECT DISTINCT c_custkey, 'not_finite', CAST(0 AS DOUBLE) FROM f)
UNION ALL SELECT c_custkey, NULL, 'problem', CAST(NULL AS DOUBLE) FROM customer WHERE c_custkey % 13 = 0""")
def terrain_roles(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of tiles of 2 x 2 cells in four roles, by each role's own decoder; every thirteenth has a byte too many."""
    tiles = terrain.terrain_stats(_tiles(spark, d)).withColumn("k", F.col("tx").cast("bigint"))
    found = tiles.where("problem IS NULL").select(F.col("k").alias("c_custkey"), "side", F.explode("stats").alias("stat", "value"))
    return found.unionByName(tiles.where("problem IS NOT NULL").select(F.col("k").alias("c_custkey"), F.lit(None).cast("int").alias("side"), F.lit("problem").alias("stat"), F.lit(None).cast("double").alias("value")))


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    """(path, length, content): a tile for each customer, in a folder for each nation; the role goes by the key."""
    k = F.col("c_custkey")
    floats = F.array(*[F.lit(struct.pack("<f", v).hex()) for v in _FLOATS])
    role = F.element_at(F.array(*map(F.lit, "hniw")), (k % 4 + 1).cast("int"))
    cells = F.when(k % 4 == 0, F.concat(*[F.element_at(floats, ((k + j) % 16 + 1).cast("int")) for j in range(4)])).otherwise(F.md5(F.col("c_name").cast("binary")))
    path = F.format_string("/w%d/t/%d_%d_%s.bin", "c_nationkey", k, k % 3, role)
    files = table(spark, d, "customer").select(path.alias("path"), F.unhex(F.concat(cells, F.when(k % 13 == 0, "00").otherwise(""))).alias("content"))
    return files.withColumn("length", F.octet_length("content").cast("bigint"))


@query("""SELECT '/w' || c_nationkey || '/t' AS dir, CAST(c_custkey AS INT) AS tx, CAST(c_custkey % 3 AS INT) AS ty, CAST(CASE WHEN c_custkey % 4 = 0 THEN n END AS BIGINT) AS h, CAST(CASE WHEN c_custkey % 4 = 1 THEN n END AS BIGINT) AS n,
CAST(CASE WHEN c_custkey % 4 = 2 THEN n END AS BIGINT) AS i, CAST(CASE WHEN c_custkey % 4 = 3 THEN n END AS BIGINT) AS w FROM (SELECT *, 16 + CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS n FROM customer)""")
def terrain_tiles(spark: SparkSession, d: str) -> DataFrame:
    """The index of terrain folders: folders of one last name below different parents are different."""
    from sheafwork.sources.records import terrain_index

    return terrain_index(_tiles(spark, d))


@query("""WITH c AS (SELECT * FROM customer WHERE c_custkey % 17 <> 0), n AS (SELECT count(*) AS n FROM c)
SELECT 'object_u8' AS form, n AS n FROM n UNION ALL SELECT 'array_u8', n FROM n UNION ALL SELECT 'ascii', 8 * n FROM n UNION ALL SELECT 'repeated', n FROM n UNION ALL SELECT 'f64', n FROM n UNION ALL SELECT 'null', n FROM n UNION ALL SELECT 'true', n FROM n
UNION ALL SELECT form, count(*) FROM (SELECT CASE WHEN v = 0 THEN 'zero' WHEN v BETWEEN 1 AND 255 THEN 'u8' ELSE 'i32' END AS form FROM (SELECT c_custkey AS v FROM c UNION ALL SELECT c_nationkey FROM c UNION ALL SELECT c_nationkey * 1000 FROM c)) GROUP BY form
UNION ALL SELECT 'same bytes', n FROM n UNION ALL SELECT 'problem', count(*) FROM customer WHERE c_custkey % 17 = 0""")
def notation_forms(spark: SparkSession, d: str) -> DataFrame:
    """Customers in object notation: the written forms of all values, and that their tapes give the same bytes; every seventeenth
    blob lacks its last byte."""
    k = F.col("c_custkey")
    row = F.struct(k.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"), F.col("c_mktsegment").alias("again"), F.col("c_acctbal").cast("double").alias("bal"))
    text = F.concat(F.expr("rtrim('}', to_json(r))"), F.format_string(',"list":[%d,%d,null,true]}', "c_nationkey", F.col("c_nationkey") * 1000))
    blobs = table(spark, d, "customer").withColumn("r", row).select(k.alias("path"), binary.json_to_notation(text).alias("content"))
    cut = F.when(F.col("path") % 17 == 0, F.call_function("substring", "content", F.lit(1), F.octet_length("content") - 1)).otherwise(F.col("content"))
    forms = binary.notation_forms(blobs.withColumn("content", cut))
    tagged = F.map_concat(F.coalesce("forms", F.create_map().cast("map<string,bigint>")), F.map_from_entries(F.array(F.struct(F.lit("same bytes"), F.coalesce(F.col("same"), F.lit(False)).cast("bigint")), F.struct(F.lit("problem"), F.col("problem").isNotNull().cast("bigint")))))
    return forms.select(F.explode(tagged).alias("form", "n")).groupBy("form").agg(F.sum("n").alias("n"))


@query("""WITH v AS (SELECT c_custkey AS k, 'name[0]' AS path, c_name || ' é <br/>' AS value FROM customer UNION ALL SELECT c_custkey, 'list[0].line0[0].col[0]', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL SELECT c_custkey, 'name[1]', '' FROM customer)
SELECT 'I' || k AS "row", path, 0 AS nth, CAST(strlen(value) AS BIGINT) AS length, value FROM v UNION ALL SELECT 'I' || c_custkey, 'name[0]', 1, strlen('twice ' || c_nationkey), 'twice ' || c_nationkey FROM customer WHERE c_custkey % 5 = 0""")
def spans_of_exports(spark: SparkSession, d: str) -> DataFrame:
    """Exports written to files, their values indexed by byte offsets and read again by range; every fifth row is there twice."""
    k = F.col("c_custkey")
    entry = F.format_string('<!-- <I> --><I%d a="1 > 0"><name>%s é <br/></name><list><line0><col>%d</col></line0></list><name/></I%d>', k, "c_name", "c_nationkey", k)
    twice = F.when(k % 5 == 0, F.format_string("<I%d><name>twice %d</name></I%d>", k, "c_nationkey", k)).otherwise("")
    rows = table(spark, d, "customer").select("c_nationkey", F.expr("c_custkey DIV 1000").alias("part"), k, F.concat(entry, twice).alias("x"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "x"))), lambda e: e["x"]), "\n")
    files = rows.groupBy("c_nationkey", "part").agg(body.alias("x"))  # a thousand keys at most in each file
    folder = fresh_folder(spark, "exports")
    files.select("c_nationkey", "part", F.concat(F.lit('<?xml version="1.0"?><cdb><sheet name="item">'), "x", F.lit("</sheet></cdb>")).alias("value")).write.partitionBy("c_nationkey", "part").text(folder)
    found = markup.read_spans(markup.span_index(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return found.select("row", "path", "nth", "length", "value")


@query("""WITH RECURSIVE types AS (
  SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'obj' WHEN 1 THEN 'null' WHEN 2 THEN 'fun' ELSE 'base' END AS kind, CASE WHEN p_partkey % 4 = 0 THEN 'T' || p_partkey WHEN p_partkey % 4 = 3 THEN 'i32' END AS name,
    CASE WHEN p_partkey % 4 = 1 THEN [p_partkey // 2] WHEN p_partkey % 4 = 2 THEN [CASE WHEN p_partkey % 20 = 2 THEN p_partkey ELSE p_partkey // 2 END, p_partkey // 3, p_partkey // 5] END AS parts FROM part),
texts AS (
  SELECT id AS root, '<' || id || '>' AS t FROM types
  UNION ALL
  SELECT root, replace(t, '<' || way || '>', CASE WHEN list_contains(list_slice(ids, 1, -2), ids[-1]) THEN '#' || ids[-1] WHEN y.id IS NULL THEN '?' || ids[-1] WHEN kind = 'null' THEN '?<' || way || '/' || parts[1] || '>'
    WHEN kind = 'fun' THEN '(<' || way || '/' || parts[1] || '>,<' || way || '/' || parts[2] || '>)-~<' || way || '/' || parts[3] || '>' ELSE name END)
  FROM (SELECT root, t, regexp_extract(t, '<([0-9/]+)>', 1) AS way, list_transform(string_split(regexp_extract(t, '<([0-9/]+)>', 1), '/'), lambda x: CAST(x AS BIGINT)) AS ids FROM texts WHERE contains(t, '<')) x LEFT JOIN types y ON y.id = x.ids[-1])
SELECT root AS id, replace(t, '-~', '->') AS display FROM texts WHERE NOT contains(t, '<')""")
def type_texts(spark: SparkSession, d: str) -> DataFrame:
    """Types that refer to smaller ones, shown; some functions take themselves, and type 0 is not there."""
    k = F.col("p_partkey").cast("bigint")
    half = lambda n: F.floor(k / n)
    kind = F.element_at(F.array(*map(F.lit, ("obj", "null", "fun", "base"))), (k % 4 + 1).cast("int"))
    name = F.when(k % 4 == 0, F.concat(F.lit("T"), k.cast("string"))).when(k % 4 == 3, "i32")
    parts = F.when(k % 4 == 1, F.array(half(2))).when(k % 4 == 2, F.array(F.when(k % 20 == 2, k).otherwise(half(2)), half(3), half(5)))
    return type_display(table(spark, d, "part").select(k.alias("id"), kind.alias("kind"), name.alias("name"), parts.alias("parts")))


def le(n: Column, bytes_: int = 4) -> Column:
    """Little-endian bytes of a number, as hexadecimal text."""
    h = F.lpad(F.hex(n.cast("bigint")), 2 * bytes_, "0")
    return F.concat(*[F.substring(h, 2 * (bytes_ - i) - 1, 2) for i in range(bytes_)])
