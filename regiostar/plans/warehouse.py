"""Star tables on plain Parquet: stable keys, year-wise replacement and all-or-nothing publication.

Every load writes new folders only. A small manifest lists the folders of the current version; it is appended last, as one
file, so readers see either the whole load or nothing of it, and a failed load leaves no trace but unused folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostar import schema
from regiostar.operators.star import fact_rows, grouped_members, members_of, new_dimensions, resolved_fact, upsert_members
from regiostar.plans.mart import GRAIN, mart_base, mart_from_base

MANIFEST = "version long, entries array<struct<`table` string, part string, path string>>"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of a null partition value
BASE_TABLE = "mart_base"
MART_TABLE = "credit_mart"
RESULTS_TABLE = "validation_results"
REJECTS_TABLE = "rejected_rows"
REJECTS = "run_id string, unresolved string, row string"

Entry = tuple[str, str, str]  # table, part (a year, or empty), path below the root


def _sql_type(kind: str) -> T.DataType:
    return T.IntegerType() if kind == "int" else T.StringType()


def dimension_schema(dimension: schema.Dimension) -> T.StructType:
    fields = [T.StructField(dimension.key, T.IntegerType())]
    return T.StructType(fields + [T.StructField(f.name, _sql_type(f.type)) for f in dimension.fields])


def fact_schema() -> T.StructType:
    fields = [T.StructField(key, T.IntegerType()) for key in schema.SURROGATE_KEYS]
    fields += [T.StructField(f.name, _sql_type(f.type)) for f in schema.FACT_FIELDS]
    fields.append(T.StructField(schema.MACRO_VALUE, T.DecimalType(15, 4)))
    return T.StructType(fields + [T.StructField(schema.YEAR, T.IntegerType())])


class Warehouse:
    """One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # Manifest

    def current(self) -> tuple[int, list[Entry]]:
        """Version number and entries; a handful of entries per dimension load and one per fact year."""
        try:
            manifest = self.spark.read.schema(MANIFEST).json(f"{self.root}/_manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return 0, []
        newest = manifest.orderBy(F.desc("version")).limit(1).collect()
        return (newest[0]["version"], [tuple(e) for e in newest[0]["entries"]]) if newest else (0, [])

    def publish(self, version: int, entries: Iterable[Entry]) -> None:
        row = self.spark.createDataFrame([(version, list(entries))], MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.root}/_manifest")

    def _folder(self, table: str) -> str:
        return f"{table}/run={uuid.uuid4().hex}"

    def _read(self, entries: Iterable[Entry], table: str, columns: T.StructType, partitioned: bool = False) -> DataFrame:
        paths = [f"{self.root}/{path}" for name, _, path in entries if name == table]
        if not paths:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.schema(columns)
        if partitioned:
            reader = reader.option("basePath", f"{self.root}/{table}")
        return reader.parquet(*paths).select(*columns.names)

    # Reading

    def dimension(self, dimension: schema.Dimension, entries: Iterable[Entry] | None = None) -> DataFrame:
        entries = self.current()[1] if entries is None else entries
        return self._read(entries, dimension.table, dimension_schema(dimension))

    def dimensions(self, entries: Iterable[Entry] | None = None) -> dict[str, DataFrame]:
        entries = self.current()[1] if entries is None else entries
        return {d.table: self.dimension(d, entries) for d in schema.DIMENSIONS}

    def fact(self, entries: Iterable[Entry] | None = None) -> DataFrame:
        entries = self.current()[1] if entries is None else entries
        return self._read(entries, schema.FACT_TABLE, fact_schema(), partitioned=True)

    def mart(self) -> DataFrame:
        """The written mart; a filter on the year reads that year's folders only."""
        present = [e for e in self.current()[1] if e[0] == MART_TABLE]
        if not present:
            raise RuntimeError("the mart has not been computed; call refresh_mart first")
        columns = mart_from_base(mart_base(self.fact([]), self.dimensions([]))).schema
        return self._read([e for e in present if e[2]], MART_TABLE, columns, partitioned=True)

    def rejects(self, run_id: str | None = None) -> DataFrame:
        """Rows that a run could not load: run, unresolved tables, and the row as JSON."""
        kept = [e for e in self.current()[1] if e[0] == REJECTS_TABLE and run_id in (None, e[1])]
        return self._read(kept, REJECTS_TABLE, T.StructType.fromDDL(REJECTS))

    # Writing

    def _write_by_year(self, df: DataFrame, table: str, hint: bool) -> dict[str, str]:
        """Write partitions by year and return the folder of each year that has rows, by its name.

        The rebalance hint gathers the rows of a year into files of the advisory size and splits a year
        that holds much of the data, so neither tiny files nor one huge task result.
        """
        folder = self._folder(table)
        rows = df.hint("rebalance", schema.YEAR) if hint else df
        rows.write.partitionBy(schema.YEAR).option("compression", "snappy").parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")
        years = [r[0] for r in written.select(schema.YEAR).distinct().collect()]
        names = [NULL_PARTITION if year is None else str(year) for year in years]
        return {name: f"{folder}/{schema.YEAR}={name}" for name in names}

    def _write_dimension(self, dimension: schema.Dimension, rows: DataFrame) -> list[Entry]:
        folder = self._folder(dimension.table)
        rows.select(*dimension_schema(dimension).names).write.parquet(f"{self.root}/{folder}")
        return [(dimension.table, "", folder)]

    def replace_all(self, cohort: DataFrame) -> None:
        """Full refresh: all five tables from one cohort, dimensions first."""
        version, _ = self.current()
        entries: list[Entry] = []
        members = new_dimensions(cohort)
        for d in schema.DIMENSIONS:
            entries += self._write_dimension(d, members[d.table])
        dimensions = self.dimensions(entries)
        no_macro = F.lit(None).cast(schema.MACRO_VALUE_TYPE).alias(schema.MACRO_VALUE)
        facts = fact_rows(cohort, dimensions).select("*", no_macro).select(*fact_schema().names)
        years = self._write_by_year(facts, schema.FACT_TABLE, hint=True)
        entries += [(schema.FACT_TABLE, year, path) for year, path in years.items()]
        self.publish(version + 1, entries)

    def load(
        self,
        cohort: DataFrame,
        fact_source: DataFrame | None = None,
        before_publish: Callable[[], None] | None = None,
        run_id: str | None = None,
    ) -> DataFrame:
        """Add new dimension members, then replace the facts of every year in the batch.

        A year of the batch whose rows are all rejected ends up empty. Other years keep their folders untouched, so
        the work grows with the batch, not with the warehouse. ``fact_source`` restricts which rows become
        facts. Returns the rejected rows; with a ``run_id`` they are also kept for ``rejects``.
        """
        version, entries = self.current()
        grouped = grouped_members(cohort)
        years = members_of(grouped, schema.PERIOD).select(schema.YEAR).dropna().distinct()
        batch_years = {str(r[0]) for r in years.collect()}
        fresh = upsert_members(grouped, self.dimensions(entries))
        for d in schema.DIMENSIONS:
            if d.table in fresh:
                entries = entries + self._write_dimension(d, fresh[d.table])
        dimensions = self.dimensions(entries)
        source = cohort if fact_source is None else fact_source
        accepted, rejected = resolved_fact(source, dimensions)
        written = self._write_by_year(accepted, schema.FACT_TABLE, hint=True)
        kept = [e for e in entries if not (e[0] == schema.FACT_TABLE and e[1] in batch_years)]
        kept += [(schema.FACT_TABLE, year, path) for year, path in written.items()]
        if run_id is not None:
            kept = [e for e in kept if not (e[0] == REJECTS_TABLE and e[1] == run_id)]
            kept += [(REJECTS_TABLE, run_id, self._write_rejects(rejected, run_id))]
        if before_publish is not None:
            before_publish()
        self.publish(version + 1, kept)
        return rejected

    def _write_rejects(self, rejected: DataFrame, run_id: str) -> str:
        folder = self._folder(REJECTS_TABLE)
        names = [F.when(F.col(d.key).isNull(), F.lit(d.table)) for d in schema.DIMENSIONS]
        row = F.to_json(F.struct(*[c for c in rejected.columns if c not in schema.SURROGATE_KEYS]))
        rows = rejected.select(F.lit(run_id).alias("run_id"), F.concat_ws(",", *names).alias("unresolved"), row.alias("row"))
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def refresh_mart(self) -> DataFrame:
        """Recompute the totals of years whose fact folder changed, then the windows over all totals.

        Only changed years are read from the fact. A change also moves the next present year's comparison and the ranks, so the
        windows run over the whole table of totals, which has one row per year, region and sector.
        """
        version, entries = self.current()
        current = {part: path for table, part, path in entries if table == schema.FACT_TABLE}
        # The part of a totals entry is "<year>|<fact folder it was computed from>".
        known = {part: path for table, part, path in entries if table == BASE_TABLE}
        done = {part.split("|", 1)[0] for part in known if current.get(part.split("|", 1)[0]) == part.split("|", 1)[1]}
        changed = sorted(set(current) - done)
        kept = [
            (BASE_TABLE, part, path) for part, path in known.items() if part.split("|", 1)[0] in done
        ]
        dimensions = self.dimensions(entries)
        if changed:
            facts = self.fact([e for e in entries if e[0] == schema.FACT_TABLE and e[1] in changed])
            folders = self._write_by_year(mart_base(facts, dimensions), BASE_TABLE, hint=False)
            for year in changed:
                # A year without a row in scope still counts as done; it points at no folder.
                kept.append((BASE_TABLE, f"{year}|{current[year]}", folders.get(year, "")))
        paths = [e for e in kept if e[2]]
        base_columns = mart_base(self.fact([]), dimensions).schema
        base = self._read(paths, BASE_TABLE, base_columns, partitioned=True)
        mart = mart_from_base(base)
        gone = {part.split("|", 1)[0] for part in known} - set(current)
        present = [e for e in entries if e[0] == MART_TABLE]
        if present:
            # A change reaches the ranks of its own year and the comparisons of later ones.
            touched = [int(year) for year in {*changed, *gone} if year != NULL_PARTITION]
            first = min(touched, default=None)
            earlier = [e for e in present if not e[1] or first is None or int(e[1]) < first]
            mart = mart.filter(F.lit(False) if first is None else F.col(schema.YEAR) >= first)
        else:
            earlier = [(MART_TABLE, "", "")]  # tells that the mart was computed, even if it has no row
        written = self._write_by_year(mart.orderBy(*GRAIN), MART_TABLE, hint=False)
        others = [e for e in entries if e[0] not in (BASE_TABLE, MART_TABLE)]
        self.publish(version + 1, [*others, *kept, *earlier, *[(MART_TABLE, year, path) for year, path in written.items()]])
        return self.mart()

