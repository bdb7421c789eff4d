"""String index without labels on the driver (M5, M6).

``StringIndexer`` collects every label of a column.  Here the index is a
table: values ranked by falling frequency (ties by value, as there), the rank
of a value being its place in its sorted partition plus the rows of the
partitions before.  Only the partitions' row counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.session import scratch_path
from driftwood.sources.sinks import write_table


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """``value, n, index``: the non-null values of a column as text, their
    frequency and their rank (from 0)."""
    spark = df.sparkSession
    counts = df.select(F.col(_q(column)).cast("string").alias("value")).where(F.col("value").isNotNull()) \
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    # partition and place are the high and low bits of the id; written, so that they stay
    placed = counts.orderBy(F.col("n").desc(), F.col("value").asc()).withColumn("_dw_at", F.monotonically_increasing_id())
    placed = spark.read.schema(placed.schema).parquet(write_table(placed, scratch_path(spark, "string-index")))
    partition = F.shiftright("_dw_at", 33).cast("int")
    sizes = placed.groupBy(partition.alias("p")).agg(F.count(F.lit(1)).alias("rows")).collect()    # one row per partition
    offsets, before = [], 0
    for r in sorted(sizes, key=lambda r: r["p"]):
        offsets.append((r["p"], before))
        before += r["rows"]
    table = spark.createDataFrame(offsets, "_dw_p int, _dw_before long")
    return placed.join(F.broadcast(table), partition == F.col("_dw_p")) \
        .select("value", "n", (F.col("_dw_before") + F.col("_dw_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("index"))


def index_column(df: DataFrame, column: str, index: DataFrame, out: str, unseen: str = "skip") -> DataFrame:
    """Replace a column's values by their rank in ``out`` (a double, as of the
    ML stage).  Values the index lacks, and nulls, are skipped, or with
    ``unseen="keep"`` get the rank after the last.

    A join, so an index of any size works; adaptive execution broadcasts a
    small one and splits a value that holds a large part of the rows.
    """
    ranks = index.select(F.col("value").alias("_dw_value"), F.col("index").cast("double").alias("_dw_index"))
    joined = df.join(ranks, F.col(_q(column)).cast("string") == F.col("_dw_value"), "left" if unseen == "keep" else "inner")
    rank = F.col("_dw_index")
    if unseen == "keep":
        rank = F.coalesce(rank, F.lit(float(index.count())))
    return joined.select(*[F.col(_q(c)) for c in df.columns if c != out], rank.alias(out))


def one_hot_positions(df: DataFrame, index_col: str, size: int, out: str) -> DataFrame:
    """One-hot encoding (M6, last category dropped) of a rank as a sparse array
    of ``struct(position, value)``, which holds for any number of categories:
    empty for the last one."""
    entry = F.struct(F.col(_q(index_col)).cast("long").alias("position"), F.lit(1.0).alias("value"))
    none = F.array().cast("array<struct<position:bigint,value:double>>")
    return df.withColumn(out, F.when(F.col(_q(index_col)) < size - 1, F.array(entry)).otherwise(none))
