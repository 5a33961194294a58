import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import TABLES, normalised, plan_faults

# one or two queries of every family; tools/check.py compares all of them
CHECKED = [
    "flagship_reconcile", "pf_union", "pf_control", "copy_plan", "data_presence", "advance_status_copy", "advance_status_validate", "finalize_metadata",
    "merge_upsert", "resolve_tokens", "group_control", "policy_compile", "policy_sync_plan", "lineage_all", "scan_issues", "apply_rewrites", "iceberg_schema",
]
@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, small, name):
    df = queries()[name](spark, small)
    cur = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert normalised(df.columns, df.collect()) == normalised(columns, cur.fetchall())


def test_entry(spark):
    assert {r.overall_status for r in entry(spark).collect()} == {"VALIDATED", "VALIDATED_WITH_WARNINGS", "VALIDATION_FAILED"}


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    own = {name for name in set(queries()) - set(oracle_sql()) if not re.match(r"op\d+_|pipeline$", name)}
    assert own == {"scan_code"}


PLANNED = [
    "pf_union", "pf_control", "copy_plan", "data_presence", "schema_diff", "reconcile_tables", "flagship_reconcile", "resolve_tokens", "copy_gate",
    "merge_upsert", "advance_status_validate", "mark_unprocessed", "policy_explode", "lineage_all", "rewrite_findings", "apply_rewrites", "scan_lines",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_join_on_keys_and_stay_in_the_jvm(spark, small, name):
    """tools/check.py --plans looks at all queries."""
    assert plan_faults(queries()[name](spark, small)) == []


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = queries()["table_scan"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in plan
