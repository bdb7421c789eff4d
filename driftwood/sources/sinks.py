"""Sinks: overwrite, keyed upsert, JDBC, ordered star refresh, CSV.

Parquet has no ``MERGE``; an upsert is a full outer join of the stored
table and the batch written to a staged folder, then swapped in.  A path is
never read and overwritten by the same plan.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.dedupe import counted, dedupe, observed


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by=None, rows_per_file: int | None = None) -> str:
    """Write a table (A5); ``partition_by`` enables pruning on period keys,
    no file gets more than ``rows_per_file`` rows."""
    w = df.write.mode(mode).format(fmt)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path


# Text formats that keep microseconds in CSV files.
CSV_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite",
              partition_by: str | None = None) -> str:
    """CSV dump, e.g. of outlier rows (A8); timestamps keep microseconds.

    ``partition_by`` writes one folder per value (one per outlier column).
    """
    w = df.write.mode(mode).options(**CSV_TIME_OPTIONS).option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)
    return path


def write_jdbc(df: DataFrame, table: str, url: str, properties: dict, mode: str = "append") -> None:
    """Append (or overwrite) a table over JDBC."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)


# ------------------------------------------------------------------ A4 --

# Rows aimed at per file of a partitioned table; a larger period is written
# by several tasks.
ROWS_PER_FILE = 5_000_000


def period_sizes(df: DataFrame, period: str) -> dict:
    """Rows per period; as many entries as there are partitions."""
    return {r[0]: r[1] for r in df.groupBy(F.col(_q(period))).agg(F.count(F.lit(1))).collect()}


def cluster_by_period(df: DataFrame, period: str, sizes: dict, spread_by=None,
                      rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows dealt out for a partitioned write (A4, A5): a period's rows meet
    in one task, so it writes one file per period instead of one per task and
    period.

    ``sizes`` gives (an upper bound of) the rows per period.  A period of more
    than ``rows_per_file`` rows is split by a hash of ``spread_by`` (default:
    all columns) into as many parts as it has multiples of that, so a hot
    period is no single task either.
    """
    parts = {v: -(-n // rows_per_file) for v, n in sizes.items() if n > rows_per_file}
    col = F.col(_q(period))
    if not parts:
        return df.repartition(col)
    # at most one row per period with more rows than one file takes
    kind = df.schema[period].dataType
    hot = df.sparkSession.createDataFrame(
        list(parts.items()), T.StructType([T.StructField("_dw_period", kind), T.StructField("_dw_parts", T.LongType())]))
    spread = F.xxhash64(*[F.col(_q(c)) for c in (spread_by or df.columns)])
    dealt = df.join(F.broadcast(hot), col.eqNullSafe(F.col("_dw_period")), "left") \
        .withColumn("_dw_part", F.pmod(spread, F.coalesce("_dw_parts", F.lit(1))))
    return dealt.repartition(col, F.col("_dw_part")).drop("_dw_period", "_dw_parts", "_dw_part")


def files_per_period(spark: SparkSession, path: str, period: str, fmt: str = "parquet", period_type=None) -> DataFrame:
    """Data files and rows of each partition of a stored table."""
    df = read_stored(spark, path, fmt, period, period_type)
    return df.select(F.col(_q(period)), F.col("_metadata.file_path").alias("_dw_file")) \
        .groupBy(period, "_dw_file").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(period).agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"))


def merge_upsert(target: DataFrame, batch: DataFrame, keys, unique: bool = False) -> DataFrame:
    """Keyed upsert as a DataFrame (A4).

    For a key present in the batch, every batch column takes the batch value
    (null included) and stored columns the batch lacks keep their value; new
    keys are inserted; stored keys absent from the batch are unchanged.  A
    null in a key is a value like any other (it matches a stored null).  The
    batch is first made unique per key (deterministically), so applying the
    same batch twice equals applying it once.  Both sides are shuffled on the
    keys once; the per-key dedupe reuses that partitioning.  ``unique`` says
    that the batch has one row per key already.
    """
    keys = list(keys)
    batch = batch if unique else dedupe(batch, keys)
    b = batch.select(*[F.col(_q(c)).alias(f"_b_{c}") for c in batch.columns]).withColumn("_in_b", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(_q(k)).eqNullSafe(F.col(_q(f"_b_{k}")))
        cond = c if cond is None else cond & c
    joined = target.join(b, cond, "full")
    in_b = F.coalesce(F.col("_in_b"), F.lit(False))
    out_cols = list(target.columns) + [c for c in batch.columns if c not in target.columns]
    exprs = []
    for c in out_cols:
        if c in keys:
            exprs.append(F.coalesce(F.col(_q(f"_b_{c}")), F.col(_q(c))).alias(c))
        elif c in batch.columns and c in target.columns:
            exprs.append(F.when(in_b, F.col(_q(f"_b_{c}"))).otherwise(F.col(_q(c))).alias(c))
        elif c in batch.columns:
            exprs.append(F.col(_q(f"_b_{c}")).alias(c))
        else:
            exprs.append(F.col(_q(c)))
    return joined.select(*exprs)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """A stored table is there when its folder exists and holds readable data
    (a folder left by an empty write has no schema to read)."""
    if not path_exists(spark, path):
        return False
    from pyspark.errors import AnalysisException
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:
        return False


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise IOError(f"could not move {source} to {target}")


def _aside(spark: SparkSession, path: str):
    """Move a live folder out of the way; its new place, or ``None`` if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}._old_{uuid.uuid4().hex[:8]}")
    _move(fs, p, old)
    return old


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Replace ``path`` by the fully written ``staged`` folder.

    The live folder is moved aside, the staged one put in its place, and the
    old one deleted last; when a move fails the old one is put back.
    """
    fs, p = _fs(spark, path)
    _, s = _fs(spark, staged)
    old = _aside(spark, path)
    try:
        _move(fs, s, p)
    except Exception:
        if old is not None:
            fs.rename(old, p)
        raise
    if old is not None:
        fs.delete(old, True)


def read_stored(spark: SparkSession, path: str, fmt: str = "parquet", partition_by: str | None = None,
                partition_type=None) -> DataFrame:
    """A stored table whose partitions may have been written at different times.

    Columns are the union over all files; the partition column has the given
    type (its values are read from the folder names, so ``01`` stays ``01``
    for text).
    """
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    df = reader.load(path)
    if partition_by and partition_type is not None:
        schema = T.StructType([T.StructField(f.name, partition_type if f.name == partition_by else f.dataType, True)
                               for f in df.schema.fields])
        df = spark.read.format(fmt).schema(schema).load(path)
    return df


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run's own, e.g. a staged copy."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys, fmt: str = "parquet",
                 partition_by: str | None = None, rows_per_file: int = ROWS_PER_FILE, staged_batch: bool = False) -> dict:
    """Upsert a batch into the stored table at ``path`` (A4); returns
    ``{"path", "written"}``, the rows of the files that were written.

    The merged table is written to a staged sibling folder and swapped in,
    so a failed job leaves the stored table untouched.  When the table is
    partitioned by a period column that is one of the keys, only the
    partitions the batch touches are read (partition pruning), merged and
    replaced; all other partitions are neither read nor rewritten, so the
    cost of a daily batch does not grow with the stored history.  The batch
    is computed once: its rows, one per key, are written beside the table
    first, and the touched periods and their sizes are read from there (with
    ``staged_batch`` it is such a stored table already).  The merged rows are
    clustered by period (:func:`cluster_by_period`) and files end at
    ``rows_per_file`` rows, so a period gets at most
    2 ceil(rows / ``rows_per_file``) files, however many tasks there are.

    Null periods have a partition of their own; folders cannot tell empty
    text from null, so an empty text period is stored as null.  Columns that
    only the batch has are added to the partitions it touches and read as
    null elsewhere (:func:`read_stored`).  Partitions are swapped one by one;
    a run that dies between two of them is completed by running it again.
    """
    keys = list(keys)
    run = uuid.uuid4().hex[:8]
    staged, own = f"{path.rstrip('/')}._staged_{run}", f"{path.rstrip('/')}._batch_{run}"
    exists = table_exists(spark, path, fmt)
    by_period = partition_by is not None and partition_by in keys
    if by_period:
        period = F.col(_q(partition_by))
        if isinstance(batch.schema[partition_by].dataType, T.StringType):
            batch = batch.withColumn(partition_by, F.nullif(period, F.lit("")))
        if not staged_batch:
            schema = batch.schema
            write_table(dedupe(batch, keys), own)
            batch = spark.read.schema(schema).parquet(own)
        # the touched periods: bounded by the number of partitions
        sizes = period_sizes(batch, partition_by)
    unique = by_period or staged_batch
    if by_period and exists:
        known = [v for v in sizes if v is not None]
        hit = period.isin(known) if known else F.lit(False)
        if len(known) < len(sizes):
            hit = hit | period.isNull()
        stored = read_stored(spark, path, fmt, partition_by, batch.schema[partition_by].dataType).where(hit)
        for value, n in period_sizes(stored, partition_by).items():
            sizes[value] = sizes.get(value, 0) + n
        merged = merge_upsert(stored, batch, keys, unique)
    elif exists:
        stored = read_stored(spark, path, fmt, partition_by,
                             batch.schema[partition_by].dataType if partition_by else None)
        merged = merge_upsert(stored, batch, keys, unique)
    else:
        merged = batch if unique else dedupe(batch, keys)
    merged, written = observed(merged, f"written-{run}")
    if by_period:
        merged = cluster_by_period(merged, partition_by, sizes, keys, rows_per_file)
    elif partition_by:
        merged = merged.hint("rebalance", F.col(_q(partition_by)))
    write_table(merged, staged, "overwrite", fmt, partition_by, rows_per_file if by_period else None)
    if by_period and exists:
        swap_partitions(spark, staged, path)
    else:
        swap_in(spark, staged, path)
    if by_period and not staged_batch:
        delete_path(spark, own)
    return {"path": path, "written": counted(written)}


def swap_partitions(spark: SparkSession, staged: str, path: str) -> None:
    """Move every partition folder of ``staged`` into ``path``, replacing
    the partitions of the same value and keeping all others."""
    fs, s = _fs(spark, staged)
    for status in fs.listStatus(s):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            swap_in(spark, status.getPath().toString(), f"{path.rstrip('/')}/{name}")
    fs.delete(s, True)


def replace_periods(spark: SparkSession, path: str, part: DataFrame, partition_by: str, fmt: str = "parquet",
                    rows_per_file: int = ROWS_PER_FILE) -> str:
    """Replace the periods that ``part`` has in a partitioned table (A5, A7);
    all other periods are neither read nor written."""
    staged = f"{path.rstrip('/')}._staged_{uuid.uuid4().hex[:8]}"
    write_table(part.hint("rebalance", F.col(_q(partition_by))), staged, "overwrite", fmt, partition_by, rows_per_file)
    if path_exists(spark, path):
        swap_partitions(spark, staged, path)
    else:
        swap_in(spark, staged, path)
    return path


# ------------------------------------------------------------------ A7 --

def stage_tables(tables: "OrderedDict[str, DataFrame]", root: str, fmt: str = "parquet",
                 partition_by: dict | None = None, rows_per_file: int = ROWS_PER_FILE) -> "OrderedDict[str, str]":
    """Write tables below ``root``, those in ``partition_by`` partitioned by
    their period column: rows of a period meet before the write, and adaptive
    execution splits a period that is too large for a task."""
    staged = OrderedDict()
    for name, df in tables.items():
        period = (partition_by or {}).get(name)
        if period:
            df = df.hint("rebalance", F.col(_q(period)))
        staged[name] = write_table(df, f"{root}/{name}", "overwrite", fmt, period, rows_per_file if period else None)
    return staged


def place_tables(spark: SparkSession, staged: "OrderedDict[str, str]", root: str) -> dict:
    """Put staged tables in the place of the live ones.

    Each live table is moved aside and its successor put in place; the old
    tables are deleted after the last one is in place, and put back if any
    move fails, so a crash never leaves the star without a copy of a table.
    """
    old, placed = {}, []
    try:
        for name in staged:
            old[name] = _aside(spark, f"{root}/{name}")
            fs, p = _fs(spark, f"{root}/{name}")
            _move(fs, _fs(spark, staged[name])[1], p)
            placed.append(name)
    except Exception:
        for name in reversed(list(old)):
            fs, p = _fs(spark, f"{root}/{name}")
            if name in placed:
                fs.delete(p, True)
            if old[name] is not None:
                fs.rename(old[name], p)
        raise
    for name in reversed(list(staged)):
        if old[name] is not None:
            _fs(spark, f"{root}/{name}")[0].delete(old[name], True)
    return {name: f"{root}/{name}" for name in staged}


def refresh_star(spark: SparkSession, tables: "OrderedDict[str, DataFrame]", base: str | None = None,
                 fmt: str = "parquet", jdbc: dict | None = None, partition_by: dict | None = None) -> dict:
    """Full refresh of a star schema (A7) in a folder, or over JDBC.

    ``tables`` is ordered parents first (dimensions, then facts).  All tables
    are written to one staged folder first, and put in place only when every
    write succeeded (:func:`place_tables`).  ``partition_by`` names the period
    column of facts that are stored partitioned.

    ``jdbc`` (``url``, ``properties``) empties the tables children first and
    appends parents first instead, from the staged copies if there is a
    ``base``.
    """
    if jdbc is not None:
        for name in reversed(list(tables)):
            tables[name].limit(0).write.option("truncate", "true") \
                .jdbc(url=jdbc["url"], table=name, mode="overwrite", properties=jdbc.get("properties", {}))
        for name, df in tables.items():
            write_jdbc(df, name, jdbc["url"], jdbc.get("properties", {}))
        return {name: name for name in tables}
    root = base.rstrip("/")
    work = f"{root}/_staged_{uuid.uuid4().hex[:8]}"
    paths = place_tables(spark, stage_tables(tables, work, fmt, partition_by), root)
    delete_path(spark, work)
    return paths


def publish_star(spark: SparkSession, tables: "OrderedDict[str, DataFrame]", base: str, audit,
                 fmt: str = "parquet", partition_by: dict | None = None) -> tuple[bool, DataFrame]:
    """Write, audit, publish (C11, A7): the staged tables are checked before
    they may replace the live ones.

    ``audit`` gets the staged tables by name and returns rows ``check_name,
    table_name, n_violations``.  If any check is violated the live star stays
    as it is, and the staged copies are removed.  Returns whether the star
    was published, and the audit's rows.
    """
    root = base.rstrip("/")
    work = f"{root}/_staged_{uuid.uuid4().hex[:8]}"
    staged = stage_tables(tables, work, fmt, partition_by)
    kinds = {n: tables[n].schema[p].dataType for n, p in (partition_by or {}).items()}
    copies = {n: read_stored(spark, p, fmt, (partition_by or {}).get(n), kinds.get(n)) if n in kinds
              else spark.read.schema(tables[n].schema).format(fmt).load(p) for n, p in staged.items()}
    rows = audit(copies)
    found = rows.collect()                                        # one row per declared constraint
    good = not any(r["n_violations"] for r in found)
    if good:
        place_tables(spark, staged, root)
    delete_path(spark, work)
    return good, spark.createDataFrame(found, rows.schema)


# names of the operator inventory
upsert = merge_upsert             # A4: keyed upsert of a batch into a stored table (as a frame)
