"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **options: str) -> SparkSession:
    """A session for tests and local runs; on a cluster the submitter's own settings apply.

    The JVM never compiles methods beyond 8,000 bytes of code; with that limit, wide cleaning projections run as
    several smaller methods instead of one that stays interpreted. Worth setting on a cluster too.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName("regiostar")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_methods(spark: SparkSession, limit: int = 8000) -> None:
    """Let wide projections run as several smaller methods in any session, unless it chose a smaller limit (see ``build_session``)."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > limit:
        spark.conf.set(name, str(limit))


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local session may do without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_root(_application: str) -> str:
    return tempfile.mkdtemp(prefix="regiostar-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{work_root(spark)}/regiostar/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The written table survives lost executors, is computed once however often it is used, and has a
    true size on disk, by which Catalyst decides whether a join may broadcast it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/regiostar")
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        own = str(store.makeQualified(root)) + "/"
        for folder in {file[: file.rindex("/")] for file in table.inputFiles()}:
            path = store.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
            if not str(path).startswith(own):
                raise ValueError(f"{folder} is no intermediate table")
            store.delete(path, True)
