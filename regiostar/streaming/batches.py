"""Monthly batches picked up from a landing folder by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.plans.warehouse import Warehouse
from regiostar.session import materialize

BATCH = "batch"


def landed_schema() -> T.StructType:
    """Columns of landed cohort rows, with the batch taken from the folder name ``batch=<name>``."""
    kinds = {"int": T.IntegerType(), "string": T.StringType()}
    fields = [T.StructField(f.name, kinds[f.type]) for f in schema.COHORT_FIELDS]
    fields.append(T.StructField(schema.MACRO_VALUE, T.DecimalType(15, 4)))
    return T.StructType([*fields, T.StructField(BATCH, T.StringType())])


def latest_by_year(rows: DataFrame) -> DataFrame:
    """Rows of the last batch that holds their year: what loading the batches one after the other would leave."""
    last = rows.groupBy(F.col(schema.YEAR).alias("_year")).agg(F.max(BATCH).alias("_last"))
    newest = materialize(last, "last-batches")
    same = (F.col(schema.YEAR) == F.col("_year")) & (F.col(BATCH) == F.col("_last"))
    return rows.join(newest, same, "left_semi")


def load_batches(spark: SparkSession, landing: str, warehouse: Warehouse, checkpoint: str) -> None:
    """Load every batch that has landed since the last call, then stop.

    The checkpoint remembers which files were taken. A batch that is replayed after a failure replaces its own
    years with the same rows. A batch folder must be complete when it appears. Rows that cannot be loaded are kept in
    ``warehouse.rejects("batch-<number>")``.
    """

    def load(rows: DataFrame, number: int) -> None:
        rows = materialize(rows, "micro-batch")
        if not rows.isEmpty():
            warehouse.load(rows.drop(BATCH), fact_source=latest_by_year(rows).drop(BATCH), run_id=f"batch-{number}")

    stream = spark.readStream.schema(landed_schema()).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
