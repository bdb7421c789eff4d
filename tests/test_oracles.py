"""A representative set of registered queries against their DuckDB oracles
at sf0.001 (the full set runs with tools/oracle_check.py)."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

SAMPLE = ["align_union", "type_conflicts", "drop_and_split_frames", "parse_double", "null_counts",
          "constraints_pk", "lookup_fallback", "fuzzy_join", "best_match", "apply_overrides",
          "dedupe_keyed", "continuous_columns", "iqr_outliers", "iqr_delete", "histogram",
          "mojibake_repair", "upsert", "star_join", "kpi_price_income", "one_hot", "hash_split",
          "flagship_outlier_audit"]


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    equal, n_spark, n_oracle = compare(spark, con, entry_mod.queries()[name], entry_mod.oracle_sql()[name],
                                       SF_SMALL)
    assert equal, f"{name}: {n_spark} spark rows vs {n_oracle} oracle rows"
