"""A partitioned table whose readers see all partitions of a publication at once.

A publication writes the partitions it changes into a folder of its own; nothing is renamed and nothing a reader may be
reading is touched. Two external tables, ``a`` and ``b``, differ by one publication only. The one that nobody reads
is brought up to date by pointing its changed partitions to the new folder (``ALTER TABLE .. PARTITION .. SET LOCATION``);
then the view that readers use is replaced by one over it, a single step in the catalog. So a row that moves from one
partition to another is there once before that step and once after it, and what a publication stopped
at is simply done again by the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfleet.schemas import empty
from wayfleet.sinks.files import folder_names, remove, spread
from wayfleet.sources.landing import decoded_path
from wayfleet.sources.tables import create_external, table_or_empty

_VERSION = "version"


@dataclass(frozen=True)
class Published:
    """Where a table is: the view ``database.name`` for readers, and its data below ``root``. Partition columns are strings."""

    database: str
    name: str
    schema: T.StructType
    partitions: Sequence[str]
    root: str

    def side(self, version: int) -> str:
        return f"{self.name}_{'ab'[version % 2]}"

    def folder(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/version={version:06d}"

    def log(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/_log/version={version:06d}"

    @property
    def log_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in (*self.partitions, "location")])


def _sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def version(spark: SparkSession, table: Published) -> int:
    """The publication that readers see; 0 before the first."""
    if not spark.catalog.tableExists(f"`{table.database}`.`{table.name}`"):
        return 0
    return int(_sql(spark, f"SHOW TBLPROPERTIES `{table.database}`.`{table.name}` ('{_VERSION}')").first()["value"])


def read(spark: SparkSession, table: Published) -> DataFrame:
    return table_or_empty(spark, table.database, table.name, table.schema).select(*table.schema.names)


def _spec(names: Sequence[str], row) -> str:
    quoted = ", ".join("`{}` = '{}'".format(n, row[n].replace("\\", "\\\\").replace("'", "\\'")) for n in names)
    return f"PARTITION ({quoted})"


def _point(spark: SparkSession, table: Published, side: str, number: int) -> None:
    """Let the partitions that a publication changed point to its folder. May be repeated."""
    name, names = f"`{table.database}`.`{side}`", table.partitions
    rows = spark.read.schema(table.log_schema).parquet(table.log(number)).collect()
    here, gone = [r for r in rows if r["location"]], [r for r in rows if not r["location"]]
    if here:
        added = " ".join(f"{_spec(names, r)} LOCATION '{r['location']}'" for r in here)
        _sql(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for r in here:
        _sql(spark, f"ALTER TABLE {name} {_spec(names, r)} SET LOCATION '{r['location']}'")
    if gone:
        _sql(spark, f"ALTER TABLE {name} DROP IF EXISTS {', '.join(_spec(names, r) for r in gone)}")


def publish(rows: DataFrame, table: Published, touched: DataFrame | None = None) -> int:
    """Replace partitions by ``rows``, their whole new content, and drop those in ``touched`` that have no rows any more.

    ``rows`` may read the table. The changed partitions are listed on the driver: the days or months of a batch. Null
    partition values are refused.
    """
    spark, names = rows.sparkSession, list(table.partitions)
    number = version(spark, table) + 1
    spread(rows.select(*table.schema.names), names).write.mode("overwrite").option("compression", "snappy").partitionBy(*names).parquet(table.folder(number))
    # Where Spark put each partition, read from its files' names; values may be spelled otherwise in a path.
    stored = spark.read.schema(table.schema).parquet(table.folder(number))
    place = F.regexp_extract(decoded_path(F.col("_metadata.file_path")), r"^(.*)/[^/]+$", 1)
    here = stored.groupBy(*names).agg(F.min(place).alias("location"))
    gone = (touched if touched is not None else here).select(*names).distinct().join(here, names, "left_anti")
    log = here.unionByName(gone.withColumn("location", F.lit(None).cast("string")))
    log.coalesce(1).write.mode("overwrite").parquet(table.log(number))
    nameless = F.lit(False)
    for n in names:
        nameless = nameless | F.col(n).isNull()
    if not spark.read.schema(table.log_schema).parquet(table.log(number)).filter(nameless).isEmpty():
        raise ValueError(f"{table.name}: rows without a value of {names}")
    for side in (0, 1):
        create_external(spark, table.database, table.side(side), table.schema, f"{table.root.rstrip('/')}/_empty", names)
    standby = table.side(number)
    for n in (number - 1, number):
        if n:
            _point(spark, table, standby, n)
    columns = ", ".join(f"`{c}`" for c in table.schema.names)
    _sql(spark, f"CREATE OR REPLACE VIEW `{table.database}`.`{table.name}` TBLPROPERTIES ('{_VERSION}' = '{number}') "
                f"AS SELECT {columns} FROM `{table.database}`.`{standby}`")
    return number


def compact(spark: SparkSession, table: Published, only: Column) -> int:
    """Write the partitions that ``only`` picks by partition columns into well-sized files, as a publication like any other."""
    # Raises unless partition columns are all it needs.
    empty(spark, T.StructType([table.schema[p] for p in table.partitions])).filter(only)
    return publish(read(spark, table).filter(only), table)


def tidy(spark: SparkSession, table: Published) -> list[str]:
    """Remove folders that neither side points to, once no reader of an older publication is left; gives their names."""
    current = version(spark, table)
    used = set()
    for side in (0, 1):
        places = spark.table(f"`{table.database}`.`{table.side(side)}`").select(
            F.regexp_extract("_metadata.file_path", r"/(version=\d+)/", 1).alias("at")).distinct()
        used |= {r["at"] for r in places.collect()}
    loose = [n for n in folder_names(spark, table.root) if n.startswith("version=") and n not in used and int(n.split("=")[1]) < current]
    for name in loose:
        remove(spark, f"{table.root.rstrip('/')}/{name}")
    return loose
