"""End-to-end jobs (J1–J9), parametrised by configuration.

The formatted-zone loads J1–J5 share one job, :func:`format_and_load`,
whose configuration switches the steps each source needs.  Drops are read
as a *family*: files with the same schema are read by one scan (their key
comes from the file path), so a folder of hundreds of daily files is a few
scans, not a union of hundreds of plans.  Alignment rules then work on the
few distinct schemas.  Actions happen only at the sinks and for the small
statistics (bounds, continuous-column detection).
"""

from __future__ import annotations

import hashlib
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.functions.text import parse_double, plain_quotes, repair_text, unix_lines, without_controls
from driftwood.operators import dedupe as dd
from driftwood.operators import features as ft
from driftwood.operators import frames as fr
from driftwood.operators import matching as mt
from driftwood.operators import outliers as ol
from driftwood.operators import quality as qa
from driftwood.sources.files import key_from_path, key_of_name
from driftwood.sources.ledger import ledger_missing_columns, ledger_type_conflicts, update_ledger
from driftwood.sources.sinks import (ROWS_PER_FILE, delete_path, place_tables, publish_star, read_stored, refresh_star,
                                     table_exists, upsert_table, write_csv, write_table)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------------- A1, A2 --

def list_files(spark: SparkSession, root: str, key_len: int | None = None,
               prefix: str | None = None) -> list[str]:
    """Drop files (or drop folders) directly below ``root`` selected by a
    digit key of ``key_len`` characters or by a name prefix (A2)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if prefix is not None and name.startswith(tuple(prefix) if isinstance(prefix, (list, tuple)) else prefix):
            out.append(status.getPath().toString())
        elif prefix is None and key_len and key_of_name(name, key_len) is not None:
            out.append(status.getPath().toString())
    return sorted(out)


def file_schemas(spark: SparkSession, paths, fmt: str = "parquet",
                 options: dict | None = None, threads: int = 16) -> "OrderedDict[str, T.StructType]":
    """The schema of every drop, read once from its footer (no Spark job);
    footers are read by a small thread pool, so thousands of drops take
    seconds."""
    from concurrent.futures import ThreadPoolExecutor

    def schema_of(p):
        return spark.read.format(fmt).options(**(options or {})).load(p).schema

    paths = list(paths)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(paths)))) as pool:
        return OrderedDict(zip(paths, pool.map(schema_of, paths)))


def read_family(spark: SparkSession, paths, key_len: int | None, key_col: str | None,
                fmt: str = "parquet", options: dict | None = None,
                schemas: dict | None = None) -> "OrderedDict[str, DataFrame]":
    """One DataFrame per distinct schema of the drops, keyed by a schema id (A1).

    Files sharing a schema are read together in one scan; the period key
    of every row comes from its file path.  Only footers are read here.
    """
    schemas = schemas or file_schemas(spark, paths, fmt, options)
    groups: OrderedDict[str, list[str]] = OrderedDict()
    by_id: dict[str, T.StructType] = {}
    for p in paths:
        sid = hashlib.sha1(schemas[p].json().encode()).hexdigest()[:10]
        groups.setdefault(sid, []).append(p)
        by_id[sid] = schemas[p]
    family = OrderedDict()
    for sid, group in groups.items():
        df = spark.read.format(fmt).options(**(options or {})).schema(by_id[sid]).load(group)
        if key_col and key_len:
            df = df.withColumn(key_col, key_from_path(F.col("_metadata.file_path"), key_len))
        family[sid] = df
    return family


def drop_reports(spark: SparkSession, schemas: dict, key_len: int | None,
                 lowercase: bool = True, flatten: bool = False):
    """Per-file schema reports of a drop family (B5, B7), from footers only.

    ``schemas`` maps each drop path to its schema.  Returns ``(missing,
    conflicts)``: rows ``(frame_key, column_name)`` for columns a file lacks,
    and ``(column_name, data_type, n_frames)`` for types not shared by every
    file.  Files of the same key get a suffix.
    """
    frames = OrderedDict()
    for i, (p, schema) in enumerate(schemas.items()):
        key = (key_of_name(p, key_len) if key_len else None) or str(i)
        key = key if key not in frames else f"{key}#{i}"
        df = spark.createDataFrame([], schema)  # metadata only
        if lowercase:
            df = fr.lowercase_columns(df)
        if flatten:
            df = fr.flatten_structs(df)
        frames[key] = df
    return fr.missing_columns_report(spark, frames), fr.type_conflicts_report(spark, frames)


# ------------------------------------------------------------- J1 .. J5 --

@dataclass
class SourceConfig:
    """What :func:`format_and_load` does for one source."""
    root: str
    target: str
    keys: list
    key_len: int | None = None          # digit key length of file names (4, 7, 10)
    key_col: str | None = None          # period column added from the file name
    key_type: str = "string"            # "int" for years (B10)
    prefix: str | tuple | None = None   # select files by name prefix(es) instead of a key (J1)
    fmt: str = "parquet"
    lowercase: bool = True              # B1
    flatten: bool = False               # B2
    align: bool = True                  # B3..B9
    overrides: dict = field(default_factory=dict)
    cast_all: bool = False
    min_columns: int | None = None      # B12
    split_bound: str | None = None      # B13: only keys above the bound are loaded
    separate_keys: list = field(default_factory=list)  # B13: keys loaded to their own table
    ranges: dict = field(default_factory=dict)         # C1
    parse_double_cols: list = field(default_factory=list)  # X1
    repair_text: bool = True            # X2
    clean_text: bool = False            # X2: plain quotes, line feeds, no control characters
    outliers: bool = False              # E4..E7
    distinct_threshold: int = 10
    outlier_exclude: list = field(default_factory=list)
    factor: float = 3.0
    delete_outliers: bool = False
    relative_error: float = 0.01
    report_dir: str | None = None       # A8: CSV of outlier rows
    partition_by: str | None = None     # A5: partition the stored table by its key
    materialize: bool = True            # write the merged frame once before the audit
    rows_per_file: int = ROWS_PER_FILE  # A5: a larger period is written by several tasks
    ledger: str | None = None           # A1: stored table of drop schemas; only new drops are opened


def repair_strings(df: DataFrame, repair=repair_text) -> DataFrame:
    """Encoding repair on every string column (X2), one projection: of whole
    texts, then of the damaged parts of others."""
    return df.select(*[repair(_q(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(_q(f.name)) for f in df.schema.fields])


def clean_strings(df: DataFrame) -> DataFrame:
    """Plain quotes, line feeds only and no control characters in every string
    column (X2, optional), one projection."""
    return repair_strings(df, lambda c: without_controls(unix_lines(plain_quotes(c))))


def _prepare(family, cfg: SourceConfig):
    out = OrderedDict()
    for sid, df in family.items():
        cols = [c for c in df.columns if c != cfg.key_col]
        if cfg.min_columns and len(cols) < cfg.min_columns:        # B12
            continue
        if cfg.lowercase:                                         # B1
            df = fr.lowercase_columns(df)
        if cfg.flatten:                                           # B2
            df = fr.flatten_structs(df)
        for c, (lo, hi) in cfg.ranges.items():                   # C1, per frame
            df = qa.valid_range(df, {c: (lo, hi)})
        for c in cfg.parse_double_cols:                           # X1, per frame, so
            if c in df.columns:                                   # text and numbers unite
                df = df.withColumn(c, parse_double(F.col(_q(c)).cast("string")))
        out[sid] = df
    return out


def _united(family, cfg: SourceConfig):
    """The frames of a family as one (U1), with counters of the rows read from
    every schema and of the rows united (E1)."""
    reads = {}
    for sid, df in family.items():
        family[sid], reads[sid] = dd.observed(df, f"read-{sid}-{uuid.uuid4().hex[:8]}")
    if cfg.align:                                                 # B3..B11
        family = fr.align(family, overrides=cfg.overrides, cast_all=cfg.cast_all)
    united, counter = dd.observed(fr.union_frames(family, allow_missing=not cfg.align), f"united-{uuid.uuid4().hex[:8]}")
    return united, {"read": reads, "united": counter}


def _finish(df: DataFrame, cfg: SourceConfig, target: str, counters: dict) -> dict:
    spark = df.sparkSession
    df = dd.dedupe(df, cfg.keys)                                  # E3
    if cfg.repair_text:                                           # X2
        df = repair_strings(df)
    if cfg.clean_text:
        df = clean_strings(df)
    df, counters["unique"] = dd.observed(df, f"unique-{uuid.uuid4().hex[:8]}")
    result = {"target": target, "bounds": {}, "report": None}
    # when several actions follow (probe, quantiles, report, dump, upsert) the
    # united, de-duplicated frame is computed once and written beside the
    # target; each action then reads the columns it needs
    staged = f"{target.rstrip('/')}._loaded_{uuid.uuid4().hex[:8]}" if cfg.materialize and cfg.outliers else None
    if staged:
        schema = df.schema
        df = spark.read.schema(schema).parquet(write_table(df, staged))
    if cfg.outliers:
        cols = ol.continuous_columns(df, cfg.distinct_threshold, cfg.outlier_exclude)   # E4
        df, bounds, report = ol.treat_outliers(df, cols, cfg.factor, cfg.delete_outliers,
                                               cfg.relative_error)                     # E5-E7
        # a row per column, kept as values: the staged rows go in the end
        result.update(bounds=bounds, report=spark.createDataFrame(report.collect(), report.schema))
        if cfg.report_dir and bounds:                            # A8
            write_csv(ol.outlier_rows(df, bounds), cfg.report_dir, header=True,
                      partition_by="outlier_column")
    written = upsert_table(spark, target, df, cfg.keys, cfg.fmt, cfg.partition_by, cfg.rows_per_file,
                           staged_batch=staged is not None)["written"]                 # A4
    if staged:
        delete_path(spark, staged)
    reads = {sid: dd.counted(o) for sid, o in counters["read"].items()}                 # E1
    result["counts"] = {"read": sum(reads.values()), "united": dd.counted(counters["united"]),
                        "unique": dd.counted(counters["unique"]), "written": written}
    result["read_by_schema"] = reads
    return result


def load_counts(spark: SparkSession, results: dict) -> DataFrame:
    """Row counts of a finished load as rows ``(target, stage, n_rows)``."""
    rows = [(name, stage, n) for name, r in results.items() if isinstance(r, dict) and "counts" in r
            for stage, n in r["counts"].items()]
    return spark.createDataFrame(rows, "target string, stage string, n_rows long")


def format_and_load(spark: SparkSession, cfg: SourceConfig) -> dict:
    """Drops → aligned, united, de-duplicated, repaired, audited → upsert.

    ``main`` (and each separate key) of the result holds ``bounds``,
    ``report``, and ``counts``: rows read, united, unique and written.  They
    are gathered by the writes themselves, no job runs for them; a stage that
    Spark runs again after a lost executor may count its rows again.
    """
    paths = list_files(spark, cfg.root, cfg.key_len, cfg.prefix)
    if cfg.ledger:
        known = update_ledger(spark, cfg.ledger, paths, cfg.key_len, cfg.fmt, cfg.lowercase, cfg.flatten)
        schemas, ledger = known["schemas"], read_stored(spark, cfg.ledger)
        missing, conflicts = ledger_missing_columns(ledger), ledger_type_conflicts(ledger)
    else:
        schemas = file_schemas(spark, paths, cfg.fmt)
        missing, conflicts = drop_reports(spark, schemas, cfg.key_len, cfg.lowercase, cfg.flatten)
    family = _prepare(read_family(spark, paths, cfg.key_len, cfg.key_col, cfg.fmt, schemas=schemas), cfg)
    if cfg.key_col and cfg.key_type != "string":
        family = OrderedDict((k, df.withColumn(cfg.key_col, F.col(cfg.key_col).cast(cfg.key_type)))
                             for k, df in family.items())
    results = {}
    key = F.col(cfg.key_col).cast("string") if cfg.key_col else None
    for sep in cfg.separate_keys:                                 # B13: e.g. one year apart
        part = OrderedDict((k, df.where(key == sep)) for k, df in family.items())
        united, counters = _united(part, cfg)
        results[sep] = _finish(united, cfg, f"{cfg.target}_{sep}", counters)
        family = OrderedDict((k, df.where(~(key == sep))) for k, df in family.items())
    if cfg.split_bound is not None:                               # B13: only the new part
        family = OrderedDict((k, df.where(key > cfg.split_bound)) for k, df in family.items())
    united, counters = _united(family, cfg)
    results["main"] = _finish(united, cfg, cfg.target, counters)
    results["missing_columns"], results["type_conflicts"] = missing, conflicts
    return results


# ------------------------------------------------------------------ J6 --

@dataclass
class ReconcileConfig:
    name_col: str                 # name in the listings
    lookup_name_col: str          # reconciled name in the lookup
    lookup_id_col: str
    row_filter: str | None = None  # C2, e.g. "municipality = 'Barcelona'"
    threshold: float = 0.3
    overrides: DataFrame | None = None
    target: str | None = None


def reconcile(listings: DataFrame, lookup: DataFrame, cfg: ReconcileConfig):
    """Names the lookup does not know → fuzzy best match → overrides.

    Returns ``(resolved, unresolved)``: the resolved-name table (name,
    reconciled name, id, similarity) and the names still unresolved.
    """
    src = listings.filter(cfg.row_filter) if cfg.row_filter else listings        # C2
    ids = lookup.select(F.col(_q(cfg.lookup_name_col)).alias("_lk_name"),
                        F.col(_q(cfg.lookup_id_col)).alias("_lk_id"))
    looked = mt.lookup_join(src.select(cfg.name_col), ids, cfg.name_col, "_lk_name")  # D1
    names = looked.where(F.col("_lk_id").isNull()).select(cfg.name_col).distinct()   # C3, E2
    cand = lookup.select(F.col(_q(cfg.lookup_name_col)).alias("reconciled_name"),
                         F.col(_q(cfg.lookup_id_col)).alias("id"))
    pairs = mt.fuzzy_join(names, cand, cfg.name_col, "reconciled_name", cfg.threshold,
                          score_col="similarity")                                 # D3
    best = mt.best_match(pairs, cfg.name_col, "similarity", ["id", "reconciled_name"])  # D4
    if cfg.overrides is not None:                                                 # D5
        best = mt.apply_overrides(best, cfg.name_col, cfg.overrides)
    left = mt.unresolved(names, best, cfg.name_col)                              # D6
    if cfg.target:                                                                # A5
        write_table(best, cfg.target)
    return best, left


def reconcile_incremental(spark: SparkSession, state: str, listings: DataFrame, lookup: DataFrame,
                          cfg: ReconcileConfig):
    """J6 over batches: ``(resolved, unresolved)`` for all names so far, as a
    full run over all listings and lookup rows would give.

    ``state`` holds the names and lookup rows seen, and the best match of each
    name.  A batch matches its new names against all lookup rows, and the old
    names against its new lookup rows; no other pair is formed again.  The
    best of the old and new matches stays, and names that a new lookup row
    knows exactly leave the result (D1).  The three tables are staged and put
    in place together.
    """
    src = listings.filter(cfg.row_filter) if cfg.row_filter else listings            # C2
    name = src.select(F.col(_q(cfg.name_col)).alias("name")).distinct()               # E2
    cand = lookup.select(F.col(_q(cfg.lookup_name_col)).alias("reconciled_name"),
                         F.col(_q(cfg.lookup_id_col)).alias("id")).distinct()
    root = state.rstrip("/")
    seen = {n: spark.read.parquet(f"{root}/{n}") for n in ("names", "lookup", "matches")} \
        if table_exists(spark, f"{root}/names") else None

    def absent(df: DataFrame, old: DataFrame, keys) -> DataFrame:
        same = [df[k].eqNullSafe(F.col(f"_dw_{k}")) for k in keys]
        return df.join(old.select(*[F.col(k).alias(f"_dw_{k}") for k in keys]), same, "left_anti")

    new_names = absent(name, seen["names"], ["name"]) if seen else name
    new_rows = absent(cand, seen["lookup"], ["reconciled_name", "id"]) if seen else cand
    names = seen["names"].unionByName(new_names) if seen else new_names
    rows = seen["lookup"].unionByName(new_rows) if seen else new_rows
    pairs = mt.fuzzy_join(new_names, rows, "name", "reconciled_name", cfg.threshold, score_col="similarity")       # D3
    if seen:
        again = mt.fuzzy_join(seen["names"], new_rows, "name", "reconciled_name", cfg.threshold, score_col="similarity")
        pairs = seen["matches"].unionByName(pairs).unionByName(again)
    best = mt.best_match(pairs, "name", "similarity", ["id", "reconciled_name"])                                   # D4
    work = f"{root}/_staged_{uuid.uuid4().hex[:8]}"
    tables = OrderedDict([("names", names), ("lookup", rows), ("matches", best)])
    staged = OrderedDict((n, write_table(df, f"{work}/{n}")) for n, df in tables.items())
    place_tables(spark, staged, root)
    delete_path(spark, work)
    now = {n: spark.read.parquet(f"{root}/{n}") for n in staged}
    exact = now["lookup"].where(F.col("id").isNotNull()).select(F.col("reconciled_name").alias("known")).distinct()   # D1
    open_names = now["names"].join(exact, F.col("name") == F.col("known"), "left_anti")                            # C3
    resolved = now["matches"].join(exact, F.col("name") == F.col("known"), "left_anti").withColumnRenamed("name", cfg.name_col)
    open_names = open_names.withColumnRenamed("name", cfg.name_col)
    if cfg.overrides is not None:                                                     # D5
        resolved = mt.apply_overrides(resolved, cfg.name_col, cfg.overrides)
    left = mt.unresolved(open_names, resolved, cfg.name_col)                          # D6
    if cfg.target:                                                                    # A5
        write_table(resolved, cfg.target)
    return resolved, left


# ------------------------------------------------------------------ J7 --

def build_star(spark: SparkSession, dims: "OrderedDict[str, DataFrame]",
               facts: "OrderedDict[str, DataFrame]", base: str, partition_by: dict | None = None) -> dict:
    """Full refresh of dimensions, then facts (A7); returns table paths."""
    return refresh_star(spark, OrderedDict(list(dims.items()) + list(facts.items())), base, partition_by=partition_by)


def build_checked_star(spark: SparkSession, dims: "OrderedDict[str, DataFrame]", facts: "OrderedDict[str, DataFrame]",
                       base: str, pks: dict, not_null: dict, fks: list, partition_by: dict | None = None):
    """J7 with the constraints as a gate (C11): tables are staged, checked and
    only then published.  Returns ``(published, report)``."""
    return publish_star(spark, OrderedDict(list(dims.items()) + list(facts.items())), base,
                        lambda tables: star_constraints(tables, pks, not_null, fks), partition_by=partition_by)


def star_constraints(tables: dict, pks: dict, not_null: dict, fks: list) -> DataFrame:
    """C11 over a star: rows ``(check_name, table_name, n_violations)``.

    ``fks`` is a list of ``(child, [fk cols], parent, [pk cols])``.  The
    primary key and the required columns of a table are checked by one
    aggregate over it.
    """
    parts = []
    for name, df in tables.items():
        keys, required = pks.get(name), not_null.get(name)
        if not keys and not required:
            continue
        missing = F.lit(False)
        for c in required or []:
            missing = missing | F.col(_q(c)).isNull()
        if keys:
            per = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias("_dw_n"),
                                                                F.count_if(missing).alias("_dw_missing"))
            both = per.agg(F.count_if(F.col("_dw_n") > 1).alias("pk"),
                           F.coalesce(F.sum("_dw_missing"), F.lit(0)).alias("not_null"))
        else:
            both = df.agg(F.lit(0).cast("long").alias("pk"), F.count_if(missing).alias("not_null"))
        checks = [c for c, wanted in (("pk", keys), ("not_null", required)) if wanted]
        rows = F.array(*[F.struct(F.lit(c).alias("check_name"), F.lit(name).alias("table_name"),
                                  F.col(c).cast("long").alias("n_violations")) for c in checks])
        parts.append(both.select(F.inline(rows)))
    for child, fk, parent, pk in fks:
        n = qa.check_fk(tables[child], fk, tables[parent], pk).agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.lit(f"fk:{parent}").alias("check_name"), F.lit(child).alias("table_name"),
                              F.col("n").alias("n_violations")))
    return fr.union_frames(parts)


# -------------------------------------------------------------- J8, J9 --

def train_job(df: DataFrame, target: str, model_dir: str, name: str, version,
              exclude=(), split_keys=None, passthrough=(), **lr_params) -> DataFrame:
    """Fit features and regression, store both under ``name/version``."""
    pm, lr, metrics = ft.train(df, target, exclude, split_keys=split_keys,
                               passthrough=passthrough, **lr_params)
    ft.save_model(pm, model_dir, f"{name}_features", version)
    ft.save_model(lr, model_dir, name, version)
    return metrics


def predict_job(df: DataFrame, model_dir: str, name: str, version) -> DataFrame:
    """Load the stored pipeline and model of a version and score."""
    return ft.score(df, ft.load_pipeline(model_dir, f"{name}_features", version),
                    ft.load_regression(model_dir, name, version))
