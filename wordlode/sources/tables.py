"""Table scans, date partitions and the date-partitioned result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scan(spark: SparkSession, source: str, *columns: str, fmt: str = "parquet") -> DataFrame:
    """A whole table: a path if it has a slash, a catalog table otherwise."""
    df = spark.read.format(fmt).load(source) if "/" in source else spark.table(source)
    return df.select(*columns) if columns else df


def run_date_column() -> Column:
    """Yesterday as yyyyMMdd, the date the job works on by default."""
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyyMMdd")


def run_date(spark: SparkSession) -> str:
    return spark.range(1).select(run_date_column()).first()[0]


def partition_name(date: str) -> str:
    return "p_" + date


def scan_partition(
    spark: SparkSession, source: str, date: str, *columns: str, partition_column: str = "p_date"
) -> DataFrame:
    """One date partition; the literal filter lets Spark skip the other folders."""
    df = scan(spark, source).where(F.col(partition_column) == F.lit(partition_name(date)))
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partition(
    df: DataFrame, path: str, date: str, partition_column: str = "p_date"
) -> None:
    """Replace one date partition and leave the others alone.

    The folder comes into being with the write, and a second run of the same
    day gives the same table.
    """
    (
        df.withColumn(partition_column, F.lit(partition_name(date)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_column)
        .parquet(path)
    )
