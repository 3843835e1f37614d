"""What several operators share: tables, columns and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmill.sources.checkpoints import written

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
# White space of the word rules below: space and \t to \r, in ASCII only.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_only(docs: DataFrame) -> DataFrame:
    """The columns of documents alone; what else a table holds is left out, so that no name clashes."""
    return docs.select(*[name for name in DOCUMENTS if name in docs.columns])


def n_words(text: Column) -> Column:
    """Number of words (runs without white space); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, groups: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the total of ``value`` over the rows of a group up to this one, in the given order.

    Range partitions cut the ordered table into pieces, rows that are equal in all of ``order`` included;
    what lies before a piece is summed over one row per piece and group, and only rows of one piece meet
    in a task. Equal rows take their places in any order. The ordered table is written once, as pieces
    must not change between the two steps.
    """
    keys = [*groups, *order, "_tie"]
    pieces = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    pieces = written(pieces.withColumn("_piece", F.spark_partition_id()))
    earlier = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy(*groups, "_piece").agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    sums = sums.select(*[F.col(name).alias(f"_{name}") for name in groups], F.col("_piece").alias("_at"), "_before")
    match = F.col("_piece") == F.col("_at")
    for name in groups:
        match = match & F.col(name).eqNullSafe(F.col(f"_{name}"))
    inside = Window.partitionBy(*groups, "_piece").orderBy(*order, "_tie")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("_before") + F.sum(value).over(inside)
    return pieces.join(sums, match).withColumn(out, total).select(*df.columns, out)
