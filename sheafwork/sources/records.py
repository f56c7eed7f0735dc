"""Line records: JSON lines whose first line is a header, tab-separated inventories, evidence and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_meta_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(meta, rows, faults) of JSON-lines files: meta (kind, meta) has the ``_meta`` header of each file, rows (kind, row) the
    others, faults (kind, line) what is no JSON.  kind is the file's name without its ending.

    A header is known by its key, not by its place, so large files still split."""
    lines = spark.read.text(path).select(F.regexp_replace(F.col("_metadata.file_name"), r"\.jsonl(\.gz)?$", "").alias("kind"), F.col("value").alias("line")).where("trim(line) <> ''")
    parsed = lines.withColumn("_v", F.try_parse_json("line"))
    meta = F.get_json_object("line", "$._meta")
    good = parsed.where("_v IS NOT NULL").select("kind", "line", meta.alias("meta"))
    return good.where("meta IS NOT NULL").select("kind", "meta"), good.where("meta IS NULL").select("kind", F.col("line").alias("row")), parsed.where("_v IS NULL").select("kind", "line")


def read_inventory(spark: SparkSession, path: str, with_offsets: bool = False) -> DataFrame:
    """path, size, flag; or path, flag, offset, size, crc (hexadecimal).  Carriage returns at line ends don't count."""
    if not with_offsets:
        df = spark.read.csv(path, sep="\t", schema="path string, size bigint, flag string")
        return df.withColumn("flag", F.rtrim(F.regexp_replace("flag", "\r$", "")))
    df = spark.read.csv(path, sep="\t", schema="path string, flag string, offset bigint, size bigint, crc string")
    return df.withColumn("crc", F.conv(F.regexp_replace("crc", "\r$", ""), 16, 10).cast("bigint"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows with their direction ``a→b`` split into from_kind and to_kind."""
    df = spark.read.schema("dir string, class string, unblock string, note string").json(path)
    ends = F.split("dir", "→")
    return df.select(F.trim(ends[0]).alias("from_kind"), F.trim(F.try_element_at(ends, F.lit(2))).alias("to_kind"), "class", "unblock", F.col("note").alias("reason"))


def pair_of_file(name: Column) -> Column:
    """(from_kind, to_kind) of ``<from>__<to>.jsonl``, null for other names."""
    hit = name.rlike(r"^[A-Za-z0-9]+__[A-Za-z0-9]+\.jsonl$")
    part = lambda k: F.when(hit, F.regexp_extract(name, r"^([A-Za-z0-9]+)__([A-Za-z0-9]+)\.jsonl$", k))
    return F.struct(part(1).alias("from_kind"), part(2).alias("to_kind"))


def read_opcodes(spark: SparkSession, path: str, partitions: int) -> DataFrame:
    """(findex, ops): gzip does not split, so rows are dealt anew after reading."""
    return spark.read.schema("findex bigint, ops array<array<int>>").json(path).repartition(partitions, "findex")


def matching_lines(spark: SparkSession, path: str, pattern: str, most: int = 3) -> DataFrame:
    """(file, lines): the numbers of the first matching lines of each text file."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("n", "line"))
    first = F.row_number().over(Window.partitionBy("file").orderBy("n"))  # a group limit below the shuffle
    hit = lines.where(F.col("line").rlike(pattern)).select("file", "n").withColumn("_rn", first).where(F.col("_rn") <= most)
    return hit.groupBy("file").agg(F.sort_array(F.collect_list(F.col("n") + 1)).alias("lines"))


def defaults_block(spark: SparkSession, path: str, begin: str, end: str) -> DataFrame:
    """key=value lines between two markers of a small text file."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", f"(?s){begin}(.*?){end}", 1).alias("t"))
    pair = text.select(F.explode(F.split("t", "\n")).alias("l")).where(F.contains("l", F.lit("=")))
    return pair.select(F.trim(F.substring_index("l", "=", 1)).alias("key"), F.trim(F.regexp_replace("l", "^[^=]*=", "")).alias("value"))


def rows_or_nothing(df: DataFrame, column: str) -> DataFrame:
    """The elements of a JSON array, or of its ``rows``; nothing for anything else."""
    v = F.try_parse_json(column)
    arr = F.coalesce(F.try_variant_get(v, "$.rows", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    return df.select(F.explode(arr).alias("row")).select(F.to_json("row").alias("row"))


def read_sheet_database(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dictionary, lines, cases) of JSON documents {sheets: [{name, columns, lines}], customTypes: [{name, cases}]}: dictionary
    (sheet, ord, name, type_str, opt, kind), lines (sheet, ord, row as JSON text), cases (type, ord, name).  A document is one
    value of its file, so it has to fit a task; its sheets and lines are dealt out from there."""
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("doc"))
    sheet = doc.select(F.explode(F.try_variant_get("doc", "$.sheets", "array<variant>")).alias("s"))
    name = F.try_variant_get("s", "$.name", "string").alias("sheet")
    field = lambda v, p, t: F.try_variant_get(v, f"$.{p}", t)
    columns = sheet.select(name, F.posexplode(F.try_variant_get("s", "$.columns", "array<variant>")).alias("ord", "c"))
    dictionary = columns.select("sheet", "ord", field("c", "name", "string").alias("name"), field("c", "typeStr", "string").alias("type_str"), F.coalesce(field("c", "opt", "boolean"), F.lit(False)).alias("opt"), field("c", "kind", "string").alias("kind"))
    lines = sheet.select(name, F.posexplode(F.try_variant_get("s", "$.lines", "array<variant>")).alias("ord", "l")).select("sheet", "ord", F.to_json("l").alias("row"))
    types = doc.select(F.explode(F.try_variant_get("doc", "$.customTypes", "array<variant>")).alias("t"))
    cases = types.select(F.try_variant_get("t", "$.name", "string").alias("type"), F.posexplode(F.try_variant_get("t", "$.cases", "array<variant>")).alias("ord", "c"))
    return dictionary, lines, cases.select("type", "ord", field("c", "name", "string").alias("name"))


def files_with_suffix(spark: SparkSession, folder: str, suffixes: list[str]) -> DataFrame:
    """(path, length, content) of the files below a folder that end in one of the suffixes; other files are not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*{" + ",".join(suffixes) + "}").load(folder)
    return files.select("path", "length", "content")


def terrain_index(files: DataFrame, roles: str = "hniw") -> DataFrame:
    """(dir, tx, ty, one column of lengths for each role) from file paths ``<dir>/<tx>_<ty>_<role>.bin``; other names are left out.
    dir is the whole path of the folder, so folders of one name below different parents stay apart.  Names that say the same
    tile and role twice (``1_2_h`` and ``01_2_h``) are in terrain_repeats; the index has the length of the smallest path."""
    cut = terrain_files(files, roles)
    return cut.groupBy("dir", "tx", "ty").agg(*[F.min_by(F.when(F.col("role") == r, F.col("length")), F.when(F.col("role") == r, F.col("path"))).alias(r) for r in roles])


def terrain_files(files: DataFrame, roles: str = "hniw") -> DataFrame:
    """(path, dir, tx, ty, role, length) of the files that are a terrain tile's."""
    pattern = rf"^(?:(.*)/)?(-?\d+)_(-?\d+)_([{roles}])\.bin$"
    part = lambda k: F.regexp_extract("path", pattern, k)
    return files.where(F.col("path").rlike(pattern)).select("path", part(1).alias("dir"), part(2).cast("int").alias("tx"), part(3).cast("int").alias("ty"), part(4).alias("role"), "length")


def terrain_repeats(files: DataFrame, roles: str = "hniw") -> DataFrame:
    """The ledger beside terrain_index: (dir, tx, ty, role, times, lengths differ) of roles that several files give."""
    one = terrain_files(files, roles).groupBy("dir", "tx", "ty", "role")
    return one.agg(F.count("*").alias("times"), (F.min("length") < F.max("length")).alias("differ")).where("times > 1")


def required(spark: SparkSession, path: str, owner: str) -> str:
    """path, if it is there and not empty; else an error that names the stage that makes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(where) or not fs.getContentSummary(where).getLength():
        raise FileNotFoundError(f"{path} is missing or empty: run {owner} first")
    return path


def read_snapshot(spark: SparkSession, folder: str, tables: dict[str, str], owner: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the tables, a ledger) of a snapshot: one folder of JSON lines for each table (name: schema), and ``header`` with the rows (table,
    rows) that each should have.  The ledger (table, wanted, found) has the tables of which that isn't true, missing ones too."""
    header = spark.read.schema("table string, rows bigint").json(required(spark, f"{folder}/header", owner))
    read = {name: spark.read.schema(schema).json(required(spark, f"{folder}/{name}", owner)) for name, schema in tables.items()}
    counts = None
    for name, df in read.items():
        one = df.agg(F.lit(name).alias("table"), F.count("*").alias("found"))
        counts = one if counts is None else counts.unionByName(one)
    both = header.select("table", F.col("rows").alias("wanted")).join(counts, "table", "full_outer")
    return read, both.where(~F.col("wanted").eqNullSafe(F.col("found")))
