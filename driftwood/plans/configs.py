"""The reference pipeline's jobs, configured for its data model.

The generic jobs in :mod:`driftwood.plans.jobs` take their settings from
these builders, so a user of the reference runs the same loads,
reconciliation, star schema and training on the same inputs.  Identifier
lists for the upserts are parameters (the reference read them from its
environment).
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.functions.keys import key_part
from driftwood.operators import star as st
from driftwood.plans.jobs import ReconcileConfig, SourceConfig, reconcile

# Fixed values of the reference pipeline.
LOOKUP_PREFIXES = ("idealista", "income")          # location lookup files
DISTINCT_THRESHOLD = 10                             # continuous-column detection
OUTLIER_FACTOR = 3.0                                # IQR factor used by every load
INCOME_RANGES = {"codi_districte": (1, 10), "codi_barri": (1, 73)}
INCOME_INDEX = "índex rfd barcelona = 100"
INCOME_OUTLIER_EXCLUDE = ["codi_districte", "codi_barri"]
LISTING_TYPES = {"distance": "int"}
LISTING_OUTLIER_EXCLUDE = ["codi_districte", "codi_barri"]
STATION_OWN_YEAR = "2018"
AIR_QUALITY_BOUND = "2019_03"
AIR_QUALITY_OUTLIER_EXCLUDE = ["codi_municipi", "codi_provincia", "estacio", "codi_contaminant"]
RECONCILE_FILTER = "municipality = 'Barcelona'"
RECONCILE_THRESHOLD = 0.3
# Manual corrections: an id fix of a matched name, and names added as
# (name, reconciled name, id, similarity).
RECONCILE_ID_FIXES = [("El Gòtic", "Q17154")]
RECONCILE_ADDED = [
    ("El Poble Sec - Parc de Montjuïc", "el Poble Sec", "Q980253", 1.0),
    ("Horta", "Horta", "Q15225338", 1.0),
]
TRAIN_TARGET = "price"
TRAIN_EXCLUDED = ["_id", "province", "country", "operation", "haslift", "newdevelopmentfinished",
                  "parkingspace_hasParkingSpace", "parkingspace_isParkingSpaceIncludedInPrice"]


# ------------------------------------------------------------ J1 .. J5 --

def _period(column: str, keys) -> str | None:
    """Partition the stored table by its period, if that is part of the key:
    a load then touches the periods of its drops only."""
    return column if column in keys else None


def location_lookup_job(root: str, target: str, keys) -> SourceConfig:
    """Lookup files by prefix, united as they are, one row per key."""
    return SourceConfig(root=root, target=target, keys=list(keys), prefix=LOOKUP_PREFIXES,
                        lowercase=False, align=False)


def station_lookup_job(root: str, target: str, keys) -> SourceConfig:
    """Yearly station files, integer year, 2018 to its own table."""
    return SourceConfig(root=root, target=target, keys=list(keys), key_len=4, key_col="year",
                        key_type="int", align=False, separate_keys=[STATION_OWN_YEAR])


def income_job(root: str, target: str, keys, delete_outliers: bool = False,
               report_dir: str | None = None) -> SourceConfig:
    """Yearly income files, valid district/neighbourhood codes, index as
    a number, outliers audited at factor 3."""
    return SourceConfig(root=root, target=target, keys=list(keys), key_len=4, align=False,
                        ranges=INCOME_RANGES, parse_double_cols=[INCOME_INDEX], outliers=True,
                        distinct_threshold=DISTINCT_THRESHOLD, outlier_exclude=INCOME_OUTLIER_EXCLUDE,
                        factor=OUTLIER_FACTOR, delete_outliers=delete_outliers, report_dir=report_dir,
                        partition_by=_period("any", keys))


def listings_job(root: str, target: str, keys, delete_outliers: bool = False,
                 report_dir: str | None = None) -> SourceConfig:
    """Daily listing files, flattened, aligned with ``distance`` as int."""
    return SourceConfig(root=root, target=target, keys=list(keys), key_len=10, key_col="day",
                        flatten=True, overrides=LISTING_TYPES, outliers=True,
                        distinct_threshold=DISTINCT_THRESHOLD, outlier_exclude=LISTING_OUTLIER_EXCLUDE,
                        factor=OUTLIER_FACTOR, delete_outliers=delete_outliers, report_dir=report_dir,
                        partition_by=_period("day", keys))


def air_quality_job(root: str, target: str, keys, delete_outliers: bool = False,
                    report_dir: str | None = None) -> SourceConfig:
    """Monthly files after 2019_03, broken files dropped, all columns
    cast to the family's types."""
    return SourceConfig(root=root, target=target, keys=list(keys), key_len=7, key_col="month",
                        min_columns=2, split_bound=AIR_QUALITY_BOUND, cast_all=True, outliers=True,
                        distinct_threshold=DISTINCT_THRESHOLD, outlier_exclude=AIR_QUALITY_OUTLIER_EXCLUDE,
                        factor=OUTLIER_FACTOR, delete_outliers=delete_outliers, report_dir=report_dir,
                        partition_by=_period("month", keys))


# ------------------------------------------------------------------ J6 --

def reconcile_listings(spark: SparkSession, listings: DataFrame, lookup: DataFrame,
                       target: str | None = None):
    """Listing neighbourhoods the lookup does not know, matched by token
    similarity, corrected, in the resolved-lookup layout
    ``neighborhood_, neighborhood_n_reconciled, neighborhood_id_, jaccard_similarity``."""
    fixes = spark.createDataFrame(RECONCILE_ID_FIXES, "neighborhood string, neighborhood_id string")
    added = spark.createDataFrame(
        RECONCILE_ADDED,
        "neighborhood string, neighborhood_n_reconciled string, neighborhood_id string, "
        "jaccard_similarity double")
    cfg = ReconcileConfig(name_col="neighborhood", lookup_name_col="neighborhood_n_reconciled",
                          lookup_id_col="neighborhood_id", row_filter=RECONCILE_FILTER,
                          threshold=RECONCILE_THRESHOLD)
    resolved, left = reconcile(listings, lookup, cfg)
    resolved = resolved.select(
        "neighborhood", F.col("reconciled_name").alias("neighborhood_n_reconciled"),
        F.col("id").cast("string").alias("neighborhood_id"),
        F.col("similarity").alias("jaccard_similarity"))
    from driftwood.operators.matching import apply_overrides, unresolved
    resolved = apply_overrides(resolved, "neighborhood", fixes, append=False)
    resolved = apply_overrides(resolved, "neighborhood", added).withColumnsRenamed(
        {"neighborhood": "neighborhood_", "neighborhood_id": "neighborhood_id_"})
    # what the fixed and added rows resolve is no longer open (D6 after the union)
    left = unresolved(left, resolved, "neighborhood", "neighborhood_")
    if target:
        from driftwood.sources.sinks import write_table
        write_table(resolved, target)
    return resolved, left


# ------------------------------------------------------------------ J7 --

def star_tables(listings: DataFrame, lookup: DataFrame, income: DataFrame, air_quality: DataFrame,
                resolved: DataFrame):
    """The four dimensions and two facts of the star, parents first."""
    days = listings.select("day")
    dims = OrderedDict([
        ("dim_location", st.dim_location(lookup, drop=[c for c in ["_id"] if c in lookup.columns])),
        ("dim_year", st.dim_year(income.select("any"), days.select(key_part("day", 0)),
                                 air_quality.select(key_part("month", 0)))),
        ("dim_month", st.dim_month(days, air_quality.select("month"))),
        ("dim_day", st.dim_day(days)),
    ])
    fact_income = st.fact_from_lookup(
        income, lookup, "nom_barri", "neighborhood",
        {"any": "year", "neighborhood_id": "neighborhood_id", "població": "population",
         INCOME_INDEX: "rfd_index"})
    fact_income = fact_income.withColumn("year", F.col("year").cast("string"))
    fact_listing = st.fact_with_fallback(
        listings, "neighborhood",
        [(lookup, "neighborhood_n_reconciled", "neighborhood_id"),
         (resolved, "neighborhood_", "neighborhood_id_")],
        "neighborhood_id",
        {c: c for c in ["propertycode", "day", "neighborhood_id", "price", "size", "rooms", "bathrooms"]},
        row_filter=F.expr(RECONCILE_FILTER))
    facts = OrderedDict([("fact_income", fact_income), ("fact_idealista", fact_listing)])
    return dims, facts


# -------------------------------------------------------------- J8, J9 --

def train_listings(listings: DataFrame, model_dir: str, version, split_keys=("propertycode", "day")):
    """The price model on the formatted listings; returns train/test metrics."""
    from driftwood.plans.jobs import train_job
    exclude = [c for c in TRAIN_EXCLUDED if c in listings.columns] + list(split_keys)
    return train_job(listings, TRAIN_TARGET, model_dir, "price", version, exclude=exclude,
                     split_keys=list(split_keys), passthrough=list(split_keys))



# ------------------------------------------------------------ E11–E14 --
# The four workbook sheets as queries on the star tables.

def kpi_price_size(fact_idealista: DataFrame) -> DataFrame:
    """Average price and size, summed rooms, per listing-day row id."""
    from driftwood.functions.keys import composite_key
    return st.kpi_per_row(fact_idealista, composite_key(["propertycode", "day"]),
                          ["price", "size"], ["rooms"])


def kpi_price_income(fact_idealista: DataFrame, fact_income: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Per neighbourhood, listing price and size next to the income
    index — the two facts meet at the location after each is aggregated."""
    both = st.drill_across(fact_idealista, fact_income, "neighborhood_id",
                           [F.avg("price").alias("avg_price"), F.avg("size").alias("avg_size")],
                           [F.avg("rfd_index").alias("avg_rfd_index")])
    named = st.star_join(both.where(F.col("avg_price").isNotNull()),
                         [(dim_location.select("neighborhood_id", "neighborhood"), "neighborhood_id",
                           "neighborhood_id")])
    return named


def kpi_rows_per_day(fact_idealista: DataFrame) -> DataFrame:
    """Listing rows per calendar day."""
    return st.kpi_rows_per_day(fact_idealista, "day")


def kpi_income_population(fact_income: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Average income index and population per district and neighbourhood."""
    return st.kpi_by_dimension(fact_income, dim_location.select("neighborhood_id", "district", "neighborhood"),
                               "neighborhood_id", "neighborhood_id", ["district", "neighborhood"],
                               ["rfd_index", "population"])
