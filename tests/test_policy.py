import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeshift.operators import lineage, policy, principals
from lakeshift.operators.windows import fill_down
from lakeshift.sources.sheets import POLICY_COLUMNS

SCHEMA = "sheet_id string, row_index long, " + ", ".join(f"`{c}` string" for c in POLICY_COLUMNS)


def sheet(spark, rows):
    return spark.createDataFrame([("s", i, *[r.get(c) for c in POLICY_COLUMNS]) for i, r in enumerate(rows)], SCHEMA)


def compile_rows(spark, rows):
    checked = policy.check_rows(policy.fill_context(sheet(spark, rows)))
    exploded = policy.explode_resources(checked)
    return checked, exploded, policy.policy_members(exploded)


def names(df):
    return sorted(r[0] for r in df.select("policy_name").distinct().collect())


def test_expansion_is_a_product(spark):
    _, exploded, _ = compile_rows(spark, [{"role": "r", "database": "d1,d2", "tables": "t1,t2", "columns": "c1,c2", "groups": "g"}])
    assert len(names(exploded)) == 8


def test_same_role_merges(spark):
    rows = [
        {"role": "a", "database": "db1", "tables": "t1", "permissions": p, "groups": "g1"} for p in ("read", "write", "read")
    ]
    _, _, members = compile_rows(spark, rows)
    merged = policy.merge_policy_roles(members).collect()
    assert [(r.policy_name, r.permissions, r.groups) for r in merged] == [("iceberg.db1.t1", ["read", "write"], ["g1"])]


SAMPLE = [
    {"role": "pilot", "database": "flights", "tables": "legs", "columns": "*", "permissions": "write", "groups": "cockpit", "users": "ines", "rowfilter": "crew = 1"},
    {"role": "pilot", "tables": "legs", "columns": "*", "permissions": "read", "groups": "cabin", "rowfilter": "crew = 2"},  # a second filter of the same role
    {"role": "planner", "tables": "slots; gates", "columns": "*", "permissions": "read", "groups": "ground", "rowfilter": "day > 1; DROP TABLE slots"},
    {"role": "planner", "tables": "slots", "columns": "*", "permissions": "read", "groups": "ground", "rowfilter": "day > 1\nOR true"},
    {"role": "auditor", "database": "flights", "url": "s3a://hangar/logs", "permissions": "read", "groups": "audit"},  # both resources
    {"role": "loader", "url": "s3a://hangar/in/*", "permissions": "write", "groups": "ingest"},
    {"role": "loader", "permissions": "read", "groups": "ingest", "policy_label": "late"},
    {"database": "crew,fuel", "tables": "roster,log", "columns": "id", "permissions": "read", "users": "omar", "policy_label": "staff"},
    {"role": "guest", "tables": "log", "columns": "id", "permissions": "read", "groups": "lobby", "item_type": "deny"},
]


@pytest.fixture(scope="module")
def sample(spark):
    return compile_rows(spark, SAMPLE)


def test_sample_sheet(sample):
    checked, exploded, members = sample
    skipped = [(r.role, r.reason) for r in policy.skipped_rows(checked).collect()]
    assert sorted(skipped) == sorted([("planner", policy.UNSAFE_ROWFILTER)] * 2 + [("auditor", policy.BOTH_OR_NEITHER)])
    assert names(exploded) == sorted(
        ["iceberg.flights.legs", "s3a://hangar/in/*", *(f"iceberg.{d}.{t}.id" for d in ("crew", "fuel") for t in ("roster", "log"))]
    )
    people = policy.role_principals(policy.role_members(checked))
    assert ("role_omar", "omar", "user") in {(r.role, r.principal, r.type) for r in people.collect()}
    labels = {r.policy_name: r.labels for r in policy.policy_headers(exploded).collect()}
    assert labels["iceberg.crew.log.id"] == ["staff"]
    merged = {(r.policy_name, r.role): r for r in policy.merge_policy_roles(members).collect()}
    assert merged["s3a://hangar/in/*", "loader"].permissions == ["read", "write"]
    both = merged["iceberg.flights.legs", "pilot"]
    assert both.rowfilter_conflict and both.groups == ["cabin", "cockpit"] and both.users == ["ines"]
    assert [r.role for r in policy.rowfilter_conflicts(members).collect()] == ["pilot"]


def test_items_and_sync_plan(spark, sample):
    _, exploded, members = sample
    mappings = spark.createDataFrame([("loader", "ingest", "group"), ("guest", "lobby", "group"), ("role_omar", "omar", "user")], "role string, principal string, type string")
    applied = policy.apply_principal_mapping(members, mappings)
    gone = {(r.policy_name, r.role): r.policy_failed for r in policy.principal_excluded(members, mappings).collect()}
    assert gone == {("iceberg.flights.legs", "pilot"): True}
    headers = policy.policy_headers(exploded)
    items = policy.policy_items(applied, headers, ["select", "use", "write"])
    log = {(r.item_list, r.role, r.access) for r in items.collect() if r.policy_name == "iceberg.fuel.log.id"}
    assert log == {(kind, role, access) for kind, role in (("allow", "role_omar"), ("deny", "guest")) for access in ("select", "use")}
    existing = spark.createDataFrame([("iceberg.crew.roster.id", "7")], "policy_name string, policy_id string")
    conflicts = policy.conflicting_policies(applied)
    plan = {r.policy_name: r.action for r in policy.policy_sync_plan(headers, items, existing, conflicts).collect()}
    assert plan["iceberg.crew.roster.id"] == "updated" and plan["iceberg.crew.log.id"] == "created" and plan["iceberg.flights.legs"] == "failed"


def test_conflicting_filters_grant_nothing(spark, sample):
    _, exploded, members = sample
    mappings = spark.createDataFrame([("pilot", "cockpit", "group"), ("loader", "ingest", "group")], "role string, principal string, type string")
    applied = policy.apply_principal_mapping(members, mappings)
    merged = {r.role: r for r in policy.merge_policy_roles(applied).collect()}
    assert merged["pilot"].permissions == [] and merged["loader"].permissions == ["read", "write"]
    headers = policy.policy_headers(exploded)
    items = policy.policy_items(applied, headers)
    assert {r.policy_name for r in items.collect()} == {"s3a://hangar/in/*"}
    existing = spark.createDataFrame([("iceberg.flights.legs", "7")], "policy_name string, policy_id string")
    plan = {r.policy_name: r for r in policy.policy_sync_plan(headers, items, existing, policy.conflicting_policies(applied)).collect()}
    legs = plan["iceberg.flights.legs"]
    assert (legs.action, legs.policy_id, legs.error) == ("failed", None, "conflicting row filters")
    assert plan["s3a://hangar/in/*"].action == "created"


def test_row_checks(spark):
    rows = [
        {"role": "r", "database": "d", "url": "s3a://x", "groups": "g"},
        {"role": "r", "groups": "g"},  # still both: the ambiguous row keeps its context
        {"role": "r", "url": "s3a://y", "rowfilter": "a=1"},
        {"role": "r", "database": "d", "rowfilter": "a=1", "item_type": "deny", "groups": "g"},
        {"database": "d", "groups": "g"},
        {"database": "d"},
    ]
    checked, _, members = compile_rows(spark, rows)
    got = sorted((r.row_index, r.reason) for r in policy.skipped_rows(checked).collect())
    assert got == [
        (0, policy.BOTH_OR_NEITHER),
        (1, policy.BOTH_OR_NEITHER),
        (2, policy.URL_ROWFILTER),
        (3, policy.ROWFILTER_IGNORED),
        (4, policy.GROUPS_WITHOUT_ROLE),
        (5, policy.NO_ROLE_BINDING),
    ]
    assert {r.kind for r in members.collect()} == {"permission", "group"}


def test_conflicting_filters_are_reported(spark):
    rows = [{"role": "r", "database": "d", "groups": "g", "rowfilter": f} for f in ("a=1", "a=2")]
    _, _, members = compile_rows(spark, rows)
    assert policy.rowfilter_conflicts(members).count() == 1
    merged = policy.merge_policy_roles(members).first()
    assert merged.rowfilter_conflict and merged.rowfilter == ""


def test_fill_down_blocks_equal_a_plain_loop(spark):
    rng = random.Random(7)
    rows = [("s", i, rng.choice([None, None, None, str(i)])) for i in range(500)] + [("t", i * 37, None if i % 4 else f"t{i}") for i in range(90)]
    want, last = {}, {}
    for s, i, v in rows:
        last[s] = v if v is not None else last.get(s)
        want[s, i] = last[s]
    df = spark.createDataFrame(rows, "sheet_id string, row_index long, v string").repartition(5)
    for block in (1, 7, 100, 10_000):
        got = fill_down(df, {"v": F.col("v")}, "row_index", ["sheet_id"], block).collect()
        assert {(r.sheet_id, r.row_index): r.v for r in got} == want


def test_item_merge(spark):
    existing = spark.createDataFrame(
        [("p", "allow", 0, ["g1", "g2"], ["u"], ["select"]), ("p", "allow", 1, ["g2"], [], ["use"])],
        "policy_name string, item_list string, item_index int, groups array<string>, users array<string>, accesses array<string>",
    )
    new = spark.createDataFrame(
        [("p", "allow", "g2", [], ["drop"]), ("p", "allow", "g9", [], ["show"]), ("p", "allow", "g9", ["v"], ["use"])],
        "policy_name string, item_list string, `group` string, users array<string>, accesses array<string>",
    )
    got = sorted((r.item_index if r.item_index is not None else 99, r.groups, r.users, r.accesses) for r in policy.merge_policy_items(existing, new).collect())
    assert got == [(0, ["g1", "g2"], ["u"], ["select"]), (1, ["g2"], [], ["drop", "use"]), (99, ["g9"], ["v"], ["show", "use"])]


def test_rowfilter_merge(spark):
    schema = "policy_name string, `group` string, users array<string>, accesses array<string>, filter_expr string"
    existing = spark.createDataFrame([("p", "g", ["u"], ["select"], "old"), ("q", "g", [], ["select"], "q"), ("z", "g", [], ["select"], "z")], schema)
    new = spark.createDataFrame([("p", "g", ["v"], ["select"], "new"), ("p", "h", [], ["select"], "h")], schema)
    updated = spark.createDataFrame([("p",), ("q",)], "policy_name string")
    got = {(r.policy_name, r.group): (r.users, r.filter_expr) for r in policy.merge_rowfilter_items(existing, new, updated).collect()}
    assert got == {("p", "g"): (["u", "v"], "new"), ("p", "h"): ([], "h"), ("z", "g"): ([], "z")}


def test_sync_plan_and_metrics(spark):
    one = lambda values, c: spark.createDataFrame([(v,) for v in values], f"`{c}` string")
    wanted = spark.createDataFrame([("r1", "g1", "group"), ("r1", "gx", "group"), ("r2", "u1", "user")], "role string, principal string, type string")
    maps = spark.createDataFrame([("r1", "g1", "group")], "role string, principal string, type string")
    plan = principals.principal_sync_plan(one(["r1", "r2"], "role"), wanted, one(["r1"], "role"), one(["g1"], "group"), one(["u1"], "user"), maps)
    got = {(r.object_type, r.object_name): r.status for r in plan.collect()}
    assert got == {
        ("role", "r1"): "ALREADY_EXISTS", ("role", "r2"): "CREATED",
        ("keycloak_group", "g1"): "ALREADY_EXISTS", ("keycloak_group", "gx"): "FAILED",
        ("mapping", "r1->g1 (group)"): "ALREADY_EXISTS", ("mapping", "r1->gx (group)"): "FAILED", ("mapping", "r2->u1 (user)"): "CREATED",
    }
    metrics = principals.policy_run_metrics(principals.status_rows(plan, "run")).first()
    assert (metrics.roles_created, metrics.mappings_created, metrics.failed_objects, metrics.overall_status) == (1, 1, 2, "PARTIAL_FAILURE")


def test_lineage_chain_in_one_join(spark):
    policies = spark.createDataFrame(
        [("r", "pol1", "1", "CREATED", ["ops"], ["u1"]), ("r", "pol2", "2", "UPDATED", ["team"], []), ("r", "bad", "3", "FAILED", ["ops"], [])],
        "run_id string, policy_name string, policy_id string, status string, groups array<string>, users array<string>",
    )
    rows = [
        ("policy", "pol1", None), ("policy", "pol1__rowfilter", ""), ("ranger_group", "ops", None), ("ranger_group", "lead", None),
        ("keycloak_group", "team", None), ("mapping", "lead->u1 (user)", None), ("mapping", "lead->team (group)", "own"), ("role", "lead", None),
    ]
    objects = spark.createDataFrame(
        [Row(run_id="r", object_type=t, object_name=n, policy_name=p, policy_id="9" if p else None) for t, n, p in rows],
        "run_id string, object_type string, object_name string, policy_name string, policy_id string",
    )
    got = {(r.object_type, r.object_name): r.policy_name for r in lineage.backfill_all(objects, policies).collect()}
    assert got == {
        ("policy", "pol1"): "pol1", ("policy", "pol1__rowfilter"): "pol1", ("ranger_group", "ops"): "pol1", ("ranger_group", "lead"): "own, pol1",
        ("keycloak_group", "team"): "pol2", ("mapping", "lead->u1 (user)"): "pol1", ("mapping", "lead->team (group)"): "own", ("role", "lead"): "own, pol1",
    }
