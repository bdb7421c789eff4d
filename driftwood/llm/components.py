"""Connected components of a link table, as DataFrame joins.

Labels spread along links and shortcut through their own labels until none
changes: the rounds grow with the logarithm of a component's diameter.
Every round is written to the shared folder, which cuts the lineage, and the
one before is removed; neither links nor labels ever reach the driver, and a hub with any number of links
is one key of a join (which Spark splits) and of partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.session import scratch_path
from driftwood.sources.sinks import delete_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of :func:`stored` tables that nothing reads any more."""
    for table in tables:
        delete_path(table.sparkSession, table.stored_at)


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links`` (columns ``a``, ``b``,
    long): the smallest id reachable.  Null ends are ignored."""
    both = links.where("a <> b").select("a", "b").distinct()
    both = stored(both.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .unionByName(both.select(F.col("b").alias("u"), F.col("a").alias("v"))), "links")
    labels = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l"))
                    .select(F.col("u").alias("id"), "l", F.lit(True).alias("changed")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("m"))
        offers = labels.select("id", "l").join(near, F.col("id") == F.col("u"))
        best = offers.select("id", F.least("l", "m").alias("l"), F.col("l").alias("was")) \
            .unionByName(offers.select(F.col("l").alias("id"), F.least("l", "m").alias("l"), F.lit(None).cast("long").alias("was"))) \
            .groupBy("id").agg(F.min("l").alias("l"), F.max("was").alias("was"))
        best, old = stored(best, "offers"), labels
        labels = stored(best.join(best.select(F.col("id").alias("j"), F.col("l").alias("ll")), F.col("l") == F.col("j"))
                        .select("id", F.col("ll").alias("l"), (F.col("ll") < F.col("was")).alias("changed")), "labels")
        discard(best, old)
        if labels.where("changed").isEmpty():
            discard(both)
            out = labels.select("id", F.col("l").alias("component"))
            out.stored_at = labels.stored_at
            return out
