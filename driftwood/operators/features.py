"""Feature preparation, regression, metrics and model versioning.

Built from Spark ML stages: ``SQLTransformer`` projections and casts,
``Imputer``, multi-column ``StringIndexer`` / ``OneHotEncoder`` (one fitting
job each for all columns), ``VectorAssembler`` and ``LinearRegression``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer,
                                StringIndexer, VectorAssembler)
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the training job: iterations, regularisation, mixing.
MAX_ITER = 10
REG_PARAM = 0.3
ELASTIC_NET_PARAM = 0.8
UNKNOWN = "UNKNOWN"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------ M1 --

def feature_roles(df: DataFrame, target: str, exclude=()) -> dict[str, list[str]]:
    """Role of each column by type (M1).

    numeric = double or int exactly; boolean; categorical = string; the
    target and excluded columns get no role.
    """
    skip = set(exclude) | {target}
    roles = {"numeric": [], "boolean": [], "categorical": []}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, (T.DoubleType, T.IntegerType)):
            roles["numeric"].append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            roles["boolean"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            roles["categorical"].append(f.name)
    return roles


def feature_roles_report(df: DataFrame, target: str, exclude=()) -> DataFrame:
    roles = feature_roles(df, target, exclude)
    rows = [(c, r) for r, cols in roles.items() for c in cols]
    return df.sparkSession.createDataFrame(rows, "column_name string, role string")


# ------------------------------------------------------------ M2 .. M8 --

def _select_stage(columns, rewrite: dict) -> SQLTransformer:
    parts = [f"{rewrite[c]} AS {_q(c)}" if c in rewrite else _q(c) for c in columns]
    return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def sql_stage(statement: str) -> SQLTransformer:
    """Templated SQL projection stage over ``__THIS__``."""
    return SQLTransformer(statement=statement)


def feature_pipeline(df: DataFrame, target: str, exclude=(), categorical_booleans: bool = False,
                     features_col: str = "features", passthrough=()) -> Pipeline:
    """The feature pipeline of the training job.

    One projection (numerics and booleans as double, null categories as
    ``UNKNOWN``) → mean imputation of numerics → string indexing by frequency
    (unseen categories skipped) → one-hot (last category dropped) → vector of
    one-hots then numerics.  Booleans are cast but, as in the reference job,
    not assembled; ``categorical_booleans`` turns them into categories
    instead (notebook variant).
    """
    roles = feature_roles(df, target, set(exclude) | set(passthrough))
    # passthrough columns (row identifiers) are kept but get no feature role
    keep = [c for c in df.columns if c not in set(exclude) or c in set(passthrough)]
    numeric, boolean, categorical = roles["numeric"], roles["boolean"], list(roles["categorical"])
    rewrite = {c: f"CAST({_q(c)} AS DOUBLE)" for c in numeric}
    rewrite |= {c: f"COALESCE({_q(c)}, '{UNKNOWN}')" for c in categorical}
    if categorical_booleans:
        rewrite |= {c: f"COALESCE(CAST({_q(c)} AS STRING), '{UNKNOWN}')" for c in boolean}
        categorical += boolean
    else:
        rewrite |= {c: f"CAST({_q(c)} AS DOUBLE)" for c in boolean}
    stages = [_select_stage(keep, rewrite)]
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=numeric, strategy="mean"))
    encoded = []
    if categorical:
        idx = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_encoded" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="skip",
                                    stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=encoded, dropLast=True))
    stages.append(VectorAssembler(inputCols=encoded + numeric, outputCol=features_col,
                                  handleInvalid="keep"))
    return Pipeline(stages=stages)


# ------------------------------------------------------------------ M9 --

def hash_bucket(key_cols) -> Column:
    """Stable bucket 0..255 from the first two hex digits of md5 of the key."""
    key = F.concat_ws("\u0001", *[F.col(_q(c)).cast("string") for c in key_cols])
    h = F.md5(key)
    digit = lambda i: F.instr(F.lit("0123456789abcdef"), F.substring(h, i, 1)) - 1
    return digit(1) * 16 + digit(2)


def hash_split(df: DataFrame, key_cols, train_buckets: int = 205) -> DataFrame:
    """Label rows ``train``/``test`` by a hash of their key (M9).

    Unlike ``randomSplit`` the label of a row does not depend on the
    partitioning, so recomputation after a lost executor gives the same split.
    """
    return df.withColumn("split", F.when(hash_bucket(key_cols) < train_buckets, "train").otherwise("test"))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """The reference's random 80/20 split with seed 42 (M9)."""
    return df.randomSplit(list(weights), seed=seed)


# ----------------------------------------------------------- M10, M11 --

def linear_regression(label: str, features_col: str = "features", max_iter: int = MAX_ITER,
                      reg_param: float = REG_PARAM, elastic_net: float = ELASTIC_NET_PARAM,
                      **kw) -> LinearRegression:
    """Elastic-net linear regression."""
    return LinearRegression(featuresCol=features_col, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, **kw)


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE and r² in one aggregate (M11): rows ``(n, rmse, r2)``.

    The total sum of squares is ``n · var_pop(label)`` (a numerically stable
    one-pass moment), not ``Σy² − n·ȳ²``.
    """
    err = F.col(_q(label)) - F.col(_q(prediction))
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(err * err).alias("sse"),
                   F.var_pop(F.col(_q(label))).alias("var_y"))
    return stats.select("n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                        (F.lit(1.0) - F.col("sse") / (F.col("var_y") * F.col("n"))).alias("r2"))


def cast_stage(columns, to_double) -> SQLTransformer:
    """``SQLTransformer`` casting ``to_double`` columns to double, rest unchanged (M2)."""
    return _select_stage(list(columns), {c: f"CAST({_q(c)} AS DOUBLE)" for c in to_double})


def unknown_stage(columns, categorical) -> SQLTransformer:
    """``SQLTransformer`` replacing null categories by ``UNKNOWN`` (M4)."""
    return _select_stage(list(columns), {c: f"COALESCE({_q(c)}, '{UNKNOWN}')" for c in categorical})


def train(df: DataFrame, target: str, exclude=(), fit_on_all: bool = False,
          split_keys=None, seed: int = 42, passthrough=(), **lr_params):
    """The training job body.

    By default the feature pipeline is fitted on the training rows only;
    ``fit_on_all`` keeps the reference order (fit on all rows, then split).
    Returns ``(pipeline_model, lr_model, metrics)``, metrics on train and test.
    """
    if split_keys:
        # split keys survive the projection, so the split label can be
        # recomputed from the scored rows (the hash is deterministic)
        passthrough = list(passthrough) + [k for k in split_keys
                                           if k in set(exclude) and k not in set(passthrough)]
    pipeline = feature_pipeline(df, target, exclude, passthrough=passthrough)
    if split_keys:
        tr = hash_split(df, split_keys).where("split = 'train'").drop("split")
        pm, lr = _fit(pipeline, df if fit_on_all else tr, tr, df, target, exclude, passthrough, lr_params)
        # one scoring pass; train and test metrics come from one grouped aggregate
        scored = hash_split(lr.transform(pm.transform(df)), split_keys)
        metrics = grouped_regression_metrics(scored, target, "split")
        return pm, lr, metrics
    tr, te = random_split(df, seed=seed)
    pm, lr = _fit(pipeline, df if fit_on_all else tr, tr, df, target, exclude, passthrough, lr_params)
    metrics = None
    for name, part in (("train", tr), ("test", te)):
        m = regression_metrics(lr.transform(pm.transform(part)), target).select(F.lit(name).alias("split"), "*")
        metrics = m if metrics is None else metrics.unionByName(m)
    return pm, lr, metrics


def _fit(pipeline: Pipeline, fit_rows: DataFrame, train_rows: DataFrame, df: DataFrame, target: str,
         exclude, passthrough, lr_params):
    """Fit the feature pipeline, then the regression, on persisted inputs.

    The pipeline's fitting jobs read the projected training rows once from
    cache; the regression's iterations read only ``(features, label)``.
    Without this every optimizer pass would recompute the feature pipeline
    from the source.  Caches are released after the fit; a lost block is
    recomputed from lineage (the split is a deterministic hash).
    """
    from pyspark import StorageLevel
    used = [c for c in df.columns if c not in set(exclude) or c in set(passthrough)]
    fit_in = fit_rows.select(*[F.col(_q(c)) for c in used]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pm = pipeline.fit(fit_in)
        source = fit_in if fit_rows is train_rows else train_rows
        feats = pm.transform(source).select("features", _q(target)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lr = linear_regression(target, **lr_params).fit(feats)
        finally:
            feats.unpersist()
    finally:
        fit_in.unpersist()
    return pm, lr


def grouped_regression_metrics(df: DataFrame, label: str, group: str,
                               prediction: str = "prediction") -> DataFrame:
    """:func:`regression_metrics` per value of ``group`` in one aggregate."""
    err = F.col(_q(label)) - F.col(_q(prediction))
    stats = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"),
                                  F.var_pop(F.col(_q(label))).alias("var_y"))
    return stats.select(group, "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                        (F.lit(1.0) - F.col("sse") / (F.col("var_y") * F.col("n"))).alias("r2"))


# ----------------------------------------------------------- A10, M12 --

def model_path(base_dir: str, name: str, version) -> str:
    return f"{base_dir.rstrip('/')}/{name}/{version}"


def save_model(model, base_dir: str, name: str, version) -> str:
    """Store a fitted model under ``name/version`` (A10)."""
    path = model_path(base_dir, name, version)
    model.write().overwrite().save(path)
    return path


def load_pipeline(base_dir: str, name: str, version) -> PipelineModel:
    return PipelineModel.load(model_path(base_dir, name, version))


def load_regression(base_dir: str, name: str, version) -> LinearRegressionModel:
    return LinearRegressionModel.load(model_path(base_dir, name, version))


def score(df: DataFrame, pipeline_model: PipelineModel, model) -> DataFrame:
    """Batch scoring with a stored pipeline and model: adds ``prediction``."""
    return model.transform(pipeline_model.transform(df))


def load_model(base_dir: str, name: str, version, kind: str = "pipeline"):
    """A10: load a stored ``pipeline`` or ``regression`` model by name and version."""
    return (load_pipeline if kind == "pipeline" else load_regression)(base_dir, name, version)
