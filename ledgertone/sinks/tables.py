"""Table and file sinks. Parquet throughout; every write can be repeated."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertone.operators.dedup import new_rows
from ledgertone.schemas import CONTROL_TABLES
from ledgertone.session import remove_path, stage
from ledgertone.sources.columns import with_safe_names


def registry_tables(spark: SparkSession, database: str) -> list[str]:
    """Create the control tables that are missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in CONTROL_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
    return list(CONTROL_TABLES)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def evolve_table(df: DataFrame, table: str) -> None:
    """Add the columns of ``df`` the table lacks."""
    spark = df.sparkSession
    present = {name.lower() for name in spark.table(table).columns}
    missing = [f for f in df.schema.fields if f.name.lower() not in present]
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append_by_name(df: DataFrame, table: str) -> None:
    """Append in the table's column order; columns the frame lacks are null."""
    target = df.sparkSession.table(table).schema
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    df.select(*columns).write.insertInto(table)


def evolve_and_append(df: DataFrame, table: str) -> None:
    if not table_exists(df.sparkSession, table):
        df.write.format("parquet").saveAsTable(table)
        return
    evolve_table(df, table)
    append_by_name(df, table)


def append_new_rows(
    batch: DataFrame, table: str, key: str = "source_record_hash", rebuild: bool = False
) -> DataFrame:
    """Append the rows whose key the table lacks; returns exactly the rows appended.

    A table of an older layout, without the key, cannot be compared. That is an error, unless the caller asks for
    a rebuild, which drops it. The table is read where it lies: only keys of the batch are looked for in it. The new rows
    are staged before the append. Everything that is counted or audited afterwards reads the staged rows, not a plan that
    would look at the grown table again.
    """
    spark = batch.sparkSession
    known = table_exists(spark, table)
    if known and key not in spark.table(table).columns:
        if not rebuild:
            raise ValueError(f"table {table} has no column {key}; pass rebuild=True to drop it and start anew")
        spark.sql(f"DROP TABLE {table}")
        known = False
    fresh = stage(new_rows(batch, spark.table(table), key) if known else batch, "append")
    evolve_and_append(fresh, table)
    return fresh


def overwrite_table(df: DataFrame, table: str) -> int:
    """Replace a table and its schema; the row count comes from the write itself.

    The new files are complete, in a folder of their own, before the table is pointed to them, and only then the old
    ones go. A failed write leaves the old table as it was.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = f"{home}/{name}-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    old = None
    if table_exists(spark, table):
        facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name IN ('Location', 'Type')").collect()
        facts = {r.col_name: r.data_type for r in facts}
        old = facts["Location"] if facts.get("Type") == "EXTERNAL" else None  # a managed table takes its files along
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    if old and old.startswith(f"{home}/{name}-"):
        remove_path(spark, old)
    return counted.get["rows"]


def overwrite_snapshot_partition(df: DataFrame, base: str, partition: str = "snapshot_date") -> None:
    """Replace only the partitions present in ``df``; a rerun leaves the same files' worth of rows."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(base)
    )


def write_reports_csv(reports: dict[str, DataFrame], base: str, snapshot_date: str) -> dict[str, str]:
    """Summary tables as one header CSV each. They have a row per dataset, so one file is right."""
    written = {}
    for name, report in reports.items():
        path = f"{base}/reports/snapshot_date={snapshot_date}/{name}"
        report.withColumn("snapshot_date", F.lit(snapshot_date)).coalesce(1).write.mode("overwrite").option(
            "header", True
        ).csv(path)
        written[name] = path
    return written


def write_raw_snapshot(df: DataFrame, path: str) -> None:
    """The source as delivered: safe column names, every value as text."""
    with_safe_names(df, stringify=True).write.mode("overwrite").parquet(path)


def write_split_previews(canonical: DataFrame, path: str) -> None:
    """Canonical CSV per split."""
    (
        canonical.write.mode("overwrite").partitionBy("split").option("header", True).option("escape", '"').csv(path)
    )


def jdbc_write_options(
    url: str, table: str, user: str, password: str, driver: str = "org.postgresql.Driver", batch_size: int = 10_000,
    connections: int = 8,
) -> dict[str, str]:
    # numPartitions bounds the open connections, whatever the width of the frame.
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "batchsize": str(batch_size), "numPartitions": str(connections), "truncate": "true",
    }


def write_jdbc(df: DataFrame, **options) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(**options)).mode("overwrite").save()


def write_manifest(manifest: DataFrame, table: str, json_path: str | None = None) -> None:
    """Manifest rows into the control table and, for people, as JSON."""
    evolve_and_append(manifest, table)
    if json_path:
        manifest.coalesce(1).write.mode("overwrite").json(json_path)


def append_run_log(
    spark: SparkSession, table: str, run_id: str, step: str, status: str, message: str, rows_written: int
) -> DataFrame:
    """One row per step, appended."""
    values = (run_id, step, status, message, int(rows_written))
    schema = T.StructType(CONTROL_TABLES["pipeline_run_log"].fields[:-1])
    row = spark.createDataFrame([values], schema).withColumn("event_ts", F.current_timestamp())
    evolve_and_append(row, table)
    return row
