"""Stage tables: where a step's result is written once and read by every later step.

Materialising is what keeps a lazy plan from calling a model twice. A stage
is replaced by writing a new version beside the old one and then pointing
a view at it, so a stage may be rebuilt from its own content and a reader
never sees half a table.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="run-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


@dataclass(frozen=True)
class StageTables:
    """The tables of one catalog schema.

    All versions of a replaced table stay, for readers that had begun on one and for looking
    back; ``prune`` drops old ones.
    """

    spark: SparkSession
    schema: str
    catalog: str | None = None

    @classmethod
    def at(cls, spark: SparkSession, schema: str, location: str | None = None,
           catalog: str | None = None) -> StageTables:
        """Open a schema, making it if it is missing."""
        tables = cls(spark, schema, catalog)
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {tables.schema_name}{place}")
        return tables

    @classmethod
    def scratch(cls, spark: SparkSession) -> StageTables:
        """A new schema in the shared folder, for one run."""
        schema = f"transqa_{uuid.uuid4().hex[:12]}"
        return cls.at(spark, schema, f"{shared_root(spark)}/{schema}")

    @property
    def schema_name(self) -> str:
        parts = [self.catalog, self.schema] if self.catalog else [self.schema]
        return ".".join(f"`{part}`" for part in parts)

    def name(self, table: str) -> str:
        return f"{self.schema_name}.`{table}`"

    def use(self) -> None:
        """Make this the session's default catalog and schema."""
        if self.catalog:
            self.spark.catalog.setCurrentCatalog(self.catalog)
        self.spark.catalog.setCurrentDatabase(self.schema)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def replace(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = (),
                buckets: tuple[int, str] | None = None) -> DataFrame:
        """Materialise a DataFrame as the new content of a table and read it back.

        ``buckets`` (count, column) writes it bucketed and sorted by that column: two tables
        of equal count join on it without moving either side.
        """
        version = f"{table}__{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
        self._write(df, version, "errorifexists", partition_by, buckets)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT * FROM {self.name(version)}"
        )
        return self.read(table)

    def prune(self, table: str, keep: int) -> None:
        """Drop all but the newest ``keep`` versions."""
        names = self.versions(table)
        for old in names[: max(0, len(names) - max(1, keep))]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")

    def append(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
        self._write(df, table, "append", partition_by)

    def create_or_load(self, table: str, columns: str,
                       partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Read a table, making it empty with declared columns when it is missing."""
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet{parts}"
        )
        return self.read(table)

    def versions(self, table: str) -> list[str]:
        """Names of a stage's versions, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {self.schema_name} LIKE '{table}__*'").collect()
        return sorted(row["tableName"] for row in found)

    def drop(self, table: str) -> None:
        """Drop a stage with all its versions."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(table)}")
        for version in self.versions(table):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")

    def _write(self, df: DataFrame, table: str, mode: str, partition_by: tuple[str, ...],
               buckets: tuple[int, str] | None = None) -> None:
        writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            count, column = buckets
            writer = writer.bucketBy(count, column).sortBy(column)
        writer.saveAsTable(self.name(table))


def spread(df: DataFrame) -> DataFrame:
    """Spread a table of too few splits over the session's cores.

    Only for work per row that costs more than moving the row. A table of many files
    has splits enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def preview(df: DataFrame, columns: list[str], key: str, rows: int = 10) -> DataFrame:
    """A few columns of the first rows by key."""
    return df.orderBy(key).limit(rows).select(*columns)
