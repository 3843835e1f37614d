"""Scans: the base table of the value workloads and the two ledger tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.schema import COUNT_MEASURES, MONTH_PROFITS, PROFIT_MEASURES, PROFIT_TYPES

INCOME_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("seq_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ds", T.DateType()),
        T.StructField("show_amount", T.DecimalType(18, 2)),
        T.StructField("payout_flag", T.IntegerType()),
        T.StructField("payout_id", T.LongType()),
        T.StructField("payout_type_id", T.IntegerType()),
        T.StructField("payout_date", T.DateType()),
    ]
)

PAYOUT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("type_id", T.IntegerType()),
        T.StructField("ds", T.DateType()),
        T.StructField("show_amount", T.DecimalType(18, 2)),
    ]
)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a catalog table, or of a parquet path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. Types are inferred (a second pass over the file) only without a schema."""
    reader = spark.read.option("header", True).option("nullValue", "NULL")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def profit_rows(base: DataFrame, types: list[str] | None = None, channel: str | None = None) -> DataFrame:
    """Rows with a registration day and a wanted profit type, measures as bigint and double.

    The filters name plain columns, so they reach the scan. ``channel`` optionally keeps one class.
    """
    has_day = F.col("ds").isNotNull()
    if isinstance(base.schema["ds"].dataType, T.StringType):
        has_day = has_day & (F.col("ds") != "")
    rows = base.where(has_day & F.col("type").isin(types or PROFIT_TYPES))
    if channel is not None:
        rows = rows.where(F.col("channel_class") == channel)
    wanted = {name: T.LongType() for name in COUNT_MEASURES}
    wanted |= {name: T.DoubleType() for name in PROFIT_MEASURES + MONTH_PROFITS}
    wanted["ds"] = T.DateType()
    casts = {
        field.name: F.col(field.name).cast(wanted[field.name])
        for field in rows.schema.fields
        if field.name in wanted and field.dataType != wanted[field.name]
    }
    return rows.withColumns(casts) if casts else rows
