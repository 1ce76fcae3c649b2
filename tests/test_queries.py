"""Every registered query against its SQL counterpart on the smallest driver tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare  # noqa: E402

from clinlake.plans import oracle, registry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


def test_every_query_has_a_counterpart():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["condition_source_code", "condition_source_display", "condition_concept_id", "count"]
    assert len(df.collect()) == 10


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, name):
    text, _, ok = compare(spark, name, registry.queries()[name], oracle.oracle_sql()[name], SF_DIR)
    assert ok, text
