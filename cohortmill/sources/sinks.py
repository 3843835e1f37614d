"""Sinks: partition overwrite of results, whole-table overwrite, CSV dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: decimals of every double in a result table.
RESULT_DECIMALS = 4


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to the decimals of a result table."""
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        double = isinstance(field.dataType, T.DoubleType)
        columns.append(f"round({name}, {RESULT_DECIMALS}) AS {name}" if double else name)
    return df.selectExpr(*columns)


def _one_partition(df: DataFrame, freq_type: str, ds: str) -> DataFrame:
    partition = {"freq_type": F.lit(freq_type), "ds": F.lit(ds)}
    body = [name for name in df.columns if name not in partition]
    return rounded(df).select(*body, *[value.alias(name) for name, value in partition.items()])


def overwrite_partition(df: DataFrame, path: str, freq_type: str, ds: str) -> None:
    """Replace the ``(freq_type, ds)`` partition of a parquet result, leaving the others alone."""
    (
        _one_partition(df, freq_type, ds)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("freq_type", "ds")
        .parquet(path)
    )


def overwrite_table_partition(df: DataFrame, table: str, freq_type: str, ds: str) -> None:
    """Replace the ``(freq_type, ds)`` partition of a catalog table, creating the table if missing."""
    spark = df.sparkSession
    rows = _one_partition(df, freq_type, ds)
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").partitionBy("freq_type", "ds").saveAsTable(table)
        return
    body = ", ".join(f"`{name}`" for name in spark.table(table).columns if name not in ("freq_type", "ds"))
    freq_text, ds_text = (value.replace("\\", "\\\\").replace("'", "\\'") for value in (freq_type, ds))
    # Naming the partition replaces it alone, whatever the session's overwrite mode.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (freq_type = '{freq_text}', ds = '{ds_text}') "
        f"SELECT {body} FROM {{rows}}",
        rows=rows,
    )


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace an unpartitioned result table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def dump_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV files with a header, for inspection."""
    df.write.mode("overwrite").option("header", True).csv(path)
