"""The session that the library expects; any other session with these settings will do."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "sheafwork", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; on a cluster, give shuffle_partitions about two for each core."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or where that is unset on one machine (tests) a temporary
    folder that is set there and removed at exit.  On a cluster it has to be set: a folder of one machine would be another folder
    on each executor."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="sheafwork-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """The name of a new folder below the shared one; what is written there goes when the driver's JVM ends."""
    above = f"{shared_folder(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(above)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(where)
    fs.deleteOnExit(where)  # of a folder that is there; what is below goes with it
    return f"{above}/data"


def staged(df: DataFrame, tag: str = "stage") -> DataFrame:
    """df written once as Parquet in the shared folder and read again: lineage, and what the planner guesses of sizes, end there; a
    lost executor costs a read.  The files go when the driver's JVM ends."""
    path = fresh_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files make fewer partitions than there are (a small table in one file); as it is otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def tasks_of(df: DataFrame) -> int:
    """The number of tasks for work that costs much a row: given with repartition(), it stands, where adaptive execution would put few
    bytes into one task."""
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def dealt(df: DataFrame) -> DataFrame:
    """df dealt evenly over all cores, for work that costs much a row: a file's rows may all lie in one row group, and so in one of its
    partitions, however many these are."""
    return df.repartition(tasks_of(df))


def table(spark: SparkSession, sf_dir: str, name: str):
    """A table of the driver's layout: one Parquet file or folder for each name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
