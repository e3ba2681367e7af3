"""Catalog tables and folders of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from wayfleet.schemas import empty


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def table_or_empty(spark: SparkSession, database: str, name: str, schema: T.StructType) -> DataFrame:
    """The table, or a typed frame without rows when it has not been created yet."""
    if spark.catalog.tableExists(f"`{database}`.`{name}`"):
        return table(spark, database, name)
    return empty(spark, schema)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet folder with a fixed schema (partition values stay strings), or no rows."""
    if folder_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return empty(spark, schema)


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row found, unlike a count."""
    return df.isEmpty()


def create_external(spark: SparkSession, database: str, name: str, schema: T.StructType, location: str,
                    partitions: Sequence[str]) -> None:
    """Create an external Parquet table unless it already exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet {split} LOCATION '{location}'"
    )


def discover_partitions(spark: SparkSession, database: str, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")


def evolve(spark: SparkSession, database: str, name: str, schema: T.StructType, partitions: Sequence[str] = ()) -> list[str]:
    """Bring a table's columns up to a layout: columns it lacks are added, and read as NULL from older files. Gives their names.

    A column whose type differs is refused before anything is changed; one the layout no longer has stays.
    """
    known = {f.name.lower(): f for f in table(spark, database, name).schema.fields}
    wanted = [f for f in schema.fields if f.name not in partitions]
    clash = [f"{f.name}: {known[f.name.lower()].dataType.simpleString()} is not {f.dataType.simpleString()}"
             for f in wanted if f.name.lower() in known and known[f.name.lower()].dataType != f.dataType]
    if clash:
        raise ValueError(f"{name} cannot take the layout: {'; '.join(clash)}")
    fresh = [f for f in wanted if f.name.lower() not in known]
    if fresh:
        spark.sql(f"ALTER TABLE `{database}`.`{name}` ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fresh)})")
    return [f.name for f in fresh]


def add_partitions(spark: SparkSession, database: str, name: str, touched: DataFrame, partitions: Sequence[str]) -> int:
    """Tell the catalog of the partitions a load wrote, and of these only; nothing is listed. Gives their number.

    ``touched`` is brought to the driver: the days or months of a load. Partitions stand below the table's location as Spark writes them.
    """
    rows = touched.select(*partitions).distinct().collect()
    if rows:
        quoted = [", ".join("`{}` = '{}'".format(p, str(r[p]).replace("\\", "\\\\").replace("'", "\\'")) for p in partitions) for r in rows]
        spark.sql(f"ALTER TABLE `{database}`.`{name}` ADD IF NOT EXISTS {' '.join(f'PARTITION ({q})' for q in quoted)}")
    return len(rows)


def partitions_of(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS `{database}`.`{name}`")


def alias_view(spark: SparkSession, view: str, database: str, name: str) -> None:
    """A second name for a table."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM `{database}`.`{name}`")


# Narrow rows for one task, and the fewest for which a task of its own pays.
ROWS_A_TASK, FEWEST_ROWS = 400_000, 25_000


def parts_for(rows: int, cores: int) -> int:
    """Over how many tasks to deal so many rows: every core has work, and none more than ``ROWS_A_TASK`` rows, however large the table."""
    return max(1, -(-rows // ROWS_A_TASK), min(cores, rows // FEWEST_ROWS))


def dealt_out(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Deal narrow rows out by key before the work that makes them wide: a file with a single row group is one task otherwise.

    With ``rows``, how many there are, the tasks are sized by what becomes of the rows. Adaptive execution sizes them by the narrow
    rows it sees, and a task's memory would be many times that.
    """
    if rows is None:
        return df.repartition(*keys)
    return df.repartition(parts_for(rows, df.sparkSession.sparkContext.defaultParallelism), *keys)
