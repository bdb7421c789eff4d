"""Ledger of drop schemas.

A folder of drops grows; the schemas of the drops that are there do not
change.  The ledger is a stored table with a row per drop and column, keyed
by the drop's path, size and time.  Only drops that it lacks (or that changed)
are opened; reports on missing columns and conflicting types are aggregates
over the ledger, and loads take the schemas from it.
"""

from __future__ import annotations

import json
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.frames import flatten_structs, lowercase_columns
from driftwood.session import scratch_path
from driftwood.sources.files import key_of_name
from driftwood.sources.sinks import _fs, read_stored, swap_in, table_exists, write_table

LEDGER = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.LongType()),
    T.StructField("frame_key", T.StringType()), T.StructField("position", T.IntegerType()),
    T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
    T.StructField("schema_json", T.StringType())])


def drop_stats(spark: SparkSession, paths) -> dict[str, tuple[int, int]]:
    """Size and time of every drop (a file, or a folder of part files)."""
    out = {}
    for p in paths:
        fs, path = _fs(spark, p)
        status = fs.getFileStatus(path)
        parts = [status] if status.isFile() else [s for s in fs.listStatus(path) if s.isFile()]
        out[p] = (sum(s.getLen() for s in parts), max([s.getModificationTime() for s in parts], default=status.getModificationTime()))
    return out


def update_ledger(spark: SparkSession, path: str, drops, key_len: int | None = None, fmt: str = "parquet",
                  lowercase: bool = True, flatten: bool = False) -> dict:
    """Bring the ledger at ``path`` up to the given drops.

    Returns ``{"schemas": drop → schema, "opened": [drops that were read]}``.
    Rows of drops that are gone or have changed are replaced.
    """
    from driftwood.plans.jobs import file_schemas
    drops = list(drops)
    stats = drop_stats(spark, drops)
    known: dict[str, tuple] = {}
    if table_exists(spark, path):
        # a row per drop: what the driver lists anyway
        rows = read_stored(spark, path).where("position = 0").select("path", "length", "modified", "schema_json").collect()
        known = {r["path"]: ((r["length"], r["modified"]), r["schema_json"]) for r in rows}
    current = {p: known[p][1] for p in drops if p in known and known[p][0] == stats[p]}
    new = [p for p in drops if p not in current]
    schemas = file_schemas(spark, new, fmt) if new else {}
    if new or set(known) - set(drops):
        rows = []
        for p in new:
            empty = spark.createDataFrame([], schemas[p])                 # metadata only
            empty = lowercase_columns(empty) if lowercase else empty
            empty = flatten_structs(empty) if flatten else empty
            key = (key_of_name(p, key_len) if key_len else None) or p.rstrip("/").rsplit("/", 1)[-1]
            rows += [(p, *stats[p], key, i, f.name, f.dataType.simpleString(), json.dumps(schemas[p].jsonValue()) if not i else None)
                     for i, f in enumerate(empty.schema.fields)]
        ledger = spark.createDataFrame(rows, LEDGER)
        if current:
            kept = spark.createDataFrame([(p,) for p in current], "path string")
            ledger = read_stored(spark, path).select(*LEDGER.fieldNames()).join(F.broadcast(kept), "path", "left_semi") \
                .unionByName(ledger)
        staged = scratch_path(spark, "ledger")
        write_table(ledger, staged)
        swap_in(spark, staged, path)
    every = {p: schemas[p] if p in schemas else T.StructType.fromJson(json.loads(current[p])) for p in drops}
    return {"schemas": OrderedDict((p, every[p]) for p in drops), "opened": new}


def ledger_missing_columns(ledger: DataFrame) -> DataFrame:
    """B5 from the ledger: rows ``frame_key, column_name`` for every column
    that other drops have and a drop lacks."""
    # distinct column names: bounded by the width of the schemas
    names = sorted(r[0] for r in ledger.select("column_name").distinct().collect())
    every = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    per = ledger.groupBy("path", "frame_key").agg(F.collect_set("column_name").alias("has"))
    return per.select("frame_key", F.explode(F.array_except(every, F.col("has"))).alias("column_name"))


def ledger_type_conflicts(ledger: DataFrame) -> DataFrame:
    """B7 from the ledger: rows ``column_name, data_type, n_frames`` of the
    columns that have more than one type."""
    per = ledger.groupBy("column_name", "data_type").agg(F.count(F.lit(1)).alias("n_frames"))
    many = per.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("column_name")
    return per.join(many, "column_name", "left_semi")
