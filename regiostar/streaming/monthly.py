"""Monthly runs: raw cohort files from a landing folder, cleaned, merged with macro values, checked, and loaded month by month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.functions.text import drop_thousands
from regiostar.operators.clean import YEAR_SOURCE, clean_and_standardise
from regiostar.operators.merge import NoRegionMatches
from regiostar.operators.quality import QualityGateError, gate
from regiostar.plans.runs import RunConfig, merged_cohort, staged_macro
from regiostar.plans.warehouse import RESULTS_TABLE, Warehouse
from regiostar.session import discard, fresh_path, materialize, small_methods
from regiostar.sources.cohort_csv import BOM, FILE, REASON, REJECTED, cut_lines, whole_numbers

BATCH, HEADER = "_batch", "_header"
LOG_TABLE, QUARANTINE_TABLE = "batch_log", "quarantined_rows"
LOADED, QUARANTINED = "loaded", "quarantined"
LOG = "micro_batch long, outcome string, reason string, delivered long, unreadable long, years array<int>, batch string"
SOURCES = [f.source for f in schema.COHORT_FIELDS]


class MonthlyRuns:
    """Batches are folders ``batch=<name>`` below ``config.cohort_path``; names sort by time.

    Each batch is a run of its own: its lines are cut, cleaned, merged with the macro values, judged by the gate and
    loaded by year. A batch is quarantined whole, and changes neither facts nor dimensions, if a file lacks the
    header, if more than ``max_unreadable`` lines can't be read, if no region matches, or if a rule fails. The next
    batch is not affected. A year belongs to the last loaded batch that holds it, whatever order batches arrive in.

    What a batch leaves behind is named by the batch and replaced as a whole, so a micro-batch that Spark starts
    again after a failure, and a ``replay``, end in the same state. Files that join a batch already seen
    make the whole folder be read again. One delimiter holds for all files.
    """

    def __init__(self, spark: SparkSession, config: RunConfig, checkpoint: str, max_unreadable: int = 0):
        if config.rules is None:
            raise ValueError("give the rules of the gate, such as standard_suite(min_rows=..., max_rows=...)")
        self.spark, self.config, self.checkpoint, self.max_unreadable = spark, config, checkpoint, max_unreadable
        small_methods(spark)
        self.landing = config.cohort_path.rstrip("/")
        self.warehouse = Warehouse(spark, config.warehouse_root)

    # What has happened

    def log(self) -> DataFrame:
        """One row per batch: the micro-batch that took it last (null for a replay), outcome, reason, counts of lines, years."""
        return self._kept(LOG_TABLE, LOG)

    def quarantined(self) -> DataFrame:
        """Lines of quarantined batches as text columns, and unreadable lines of all batches, with file, reason and batch."""
        texts = ", ".join(f"`{name}` string" for name in SOURCES)
        return self._kept(QUARANTINE_TABLE, f"{texts}, {REJECTED} string, {REASON} string, {FILE} string, batch string")

    def _kept(self, table: str, columns: str) -> DataFrame:
        try:
            return self.spark.read.schema(columns).parquet(f"{self.warehouse.root}/{table}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], columns)

    # Running

    def run(self) -> None:
        """Take every batch that has landed since the last call, then stop."""
        lines = self._lines(self.spark.readStream.format("text").load(self.landing))
        stream = lines.writeStream.foreachBatch(self._take).option("checkpointLocation", self.checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()

    def replay(self, batch: str) -> None:
        """Run a landed batch again, such as a quarantined one after its files or the rules were corrected."""
        self._take(self._folder(batch), None)

    def _folder(self, batch: str) -> DataFrame:
        return self._lines(self.spark.read.text(f"{self.landing}/batch={batch}"))

    @staticmethod
    def _lines(texts: DataFrame) -> DataFrame:
        path = F.col("_metadata.file_path")
        batch = F.regexp_extract(path, "/batch=([^/]+)/", 1)
        return texts.select(F.ltrim("value", F.lit(BOM)).alias("line"), path.alias(FILE), batch.alias(BATCH)).filter(F.col(BATCH) != "")

    def _cut(self, lines: DataFrame) -> DataFrame:
        """Lines as text columns, written once by batch, so that each batch reads its own folder."""
        rows = cut_lines(lines, SOURCES, self.config.delimiter or ",", keep=[BATCH])
        same = [F.equal_null(F.trim(F.col(f"`{name}`")), F.lit(name)) for name in SOURCES]
        header = F.lit(True)
        for condition in same:
            header = header & condition
        year = F.col(f"`{YEAR_SOURCE}`")
        unreadable_year = year.isNotNull() & drop_thousands(year).try_cast("int").isNull()
        broken = F.col(REASON).isNull() & ~F.col(HEADER) & unreadable_year
        rows = rows.withColumn(HEADER, header).withColumn(REASON, F.when(broken, "year is no number").otherwise(F.col(REASON)))
        path = fresh_path(self.spark, "landed-rows")
        rows.write.partitionBy(BATCH).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _take(self, lines: DataFrame, number: int | None) -> None:
        rows = self._cut(lines)
        names = [r[0] for r in rows.select(BATCH).distinct().orderBy(BATCH).collect()]
        if not names:
            return
        seen = {r[0] for r in self.log().select("batch").collect()}
        macro = staged_macro(self.spark, self.config)
        loaded = False
        for name in names:
            whole = number is not None and name in seen
            own = self._cut(self._folder(name)) if whole else rows.filter(F.col(BATCH) == name)
            loaded |= self._run_batch(own.drop(BATCH), name, number, macro)
            if whole:
                discard(own)
        discard(rows)
        if loaded:
            self.warehouse.refresh_mart()

    def _run_batch(self, rows: DataFrame, name: str, number: int | None, macro: DataFrame) -> bool:
        unreadable, header = F.col(REASON).isNotNull(), F.col(HEADER)
        counts = rows.agg(
            F.count_if(~header).alias("delivered"),
            F.count_if(unreadable).alias("unreadable"),
            F.count_distinct(FILE).alias("files"),
            F.count_distinct(F.when(header, F.col(FILE))).alias("headed"),
        ).first()
        reason, merged = None, None
        if counts.headed < counts.files:
            reason = f"{counts.files - counts.headed} of {counts.files} files lack the header"
        elif counts.unreadable > self.max_unreadable:
            reason = f"{counts.unreadable} of {counts.delivered} lines can't be read"
        elif counts.delivered == counts.unreadable:
            reason = "no rows"
        else:
            readable = rows.filter(~header & ~unreadable).select(*[f"`{n}`" for n in SOURCES])
            # Not written: the merge reads two of the columns for its counts, and all of them once more.
            cohort = clean_and_standardise(whole_numbers(readable))
            try:
                merged = materialize(merged_cohort(cohort, macro, self.config.threshold)[0], "merged")
                gate(merged, self.config.rules, f"{self.warehouse.root}/{RESULTS_TABLE}", name)
            except (QualityGateError, NoRegionMatches) as error:
                reason = str(error)
        held = rows.filter(~header) if reason else rows.filter(unreadable)
        held = held.drop(HEADER).withColumn(REASON, F.coalesce(REASON, F.lit(reason)))
        self._replace(QUARANTINE_TABLE, name, held)
        years: list[int] = []
        if reason is None:
            years = self._load(merged, name)
        entry = (number, QUARANTINED if reason else LOADED, reason, counts.delivered, counts.unreadable, years)
        columns = LOG.removesuffix(", batch string")
        self._replace(LOG_TABLE, name, self.spark.createDataFrame([entry], columns).coalesce(1))
        if merged is not None:
            discard(merged)
        return reason is None

    def _load(self, merged: DataFrame, name: str) -> list[int]:
        """Load the years that no later batch has loaded; return all years of the batch."""
        years = [r[0] for r in merged.select(schema.YEAR).distinct().collect()]
        later = self.log().filter((F.col("batch") > name) & (F.col("outcome") == LOADED))
        taken = later.select(F.explode("years").alias(schema.YEAR)).distinct()
        self.warehouse.load(merged.join(taken, schema.YEAR, "left_anti"), run_id=name)
        return sorted(year for year in years if year is not None)

    def _replace(self, table: str, batch: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.warehouse.root}/{table}/batch={batch}")
