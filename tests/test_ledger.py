import pytest
from pyspark.sql import functions as F

from lakeshift.operators import ledger as ops
from lakeshift.operators import reconcile, report
from lakeshift.plans import runs
from lakeshift.schemas import LEDGERS, ledger_schema

K = ("run", "db")


def ledger(spark, rows):
    """Rows of (table, {column: value}) as a table ledger."""
    schema = ledger_schema("migration_table_status")
    base = {"run_id": "run", "source_database": "db", "dest_database": "lake"}
    return spark.createDataFrame([[{**base, "source_table": t, **v}.get(c) for c in schema.names] for t, v in rows], schema)


def results(spark, rows, schema):
    return spark.createDataFrame([("run", "db", t, "lake", *v) for t, *v in rows], f"run_id string, source_database string, source_table string, dest_database string, {schema}")


def by_table(df, *cols):
    return {r.source_table: tuple(r[c] for c in cols) for r in df.collect()}


def test_create_never_leaves_failed(spark):
    state = ledger(spark, [("a", {"overall_status": "FAILED"}), ("b", {"overall_status": "COPIED"}), ("c", {"overall_status": "DATA_MISSING"}), ("d", {})])
    found = results(spark, [(t, "COMPLETED", None, None) for t in "abcd"], "status string, existed boolean, error string")
    assert by_table(ops.advance_create(state, found), "overall_status") == {"a": ("FAILED",), "b": ("TABLE_CREATED",), "c": ("TABLE_CREATED",), "d": (None,)}
    meta = by_table(ops.advance_create(state, found, metadata=True), "overall_status")
    assert meta == {"a": ("FAILED",), "b": ("TABLE_CREATED",), "c": ("DATA_MISSING",), "d": ("TABLE_CREATED",)}


@pytest.mark.parametrize(
    "flags, copy, convert, metadata",
    [
        ((True, True, True), "VALIDATED", "VALIDATED", "VALIDATED"),
        ((False, True, True), "VALIDATED_WITH_WARNINGS", "VALIDATION_FAILED", "VALIDATION_FAILED"),
        ((True, False, True), "VALIDATED_WITH_WARNINGS", "VALIDATION_FAILED", "VALIDATION_FAILED"),
        ((True, True, False), "VALIDATION_FAILED", "VALIDATION_FAILED", "VALIDATION_FAILED"),
        ((True, None, True), "VALIDATION_FAILED", "VALIDATED", "VALIDATION_FAILED"),
    ],
)
def test_verdicts(spark, flags, copy, convert, metadata):
    df = spark.createDataFrame([flags], "row_count_match boolean, partition_count_match boolean, schema_match boolean")
    assert tuple(df.select(*[reconcile.validation_status(v) for v in ("copy", "convert", "metadata")]).first()) == (copy, convert, metadata)


def test_patch_and_catch_all(spark):
    state = ledger(spark, [("a", {"discovery_status": "COMPLETED"}), ("b", {"discovery_status": "COMPLETED", "distcp_status": "COMPLETED"}), ("c", {"discovery_status": "FAILED"}), ("d", {"discovery_status": "COMPLETED", "error_message": "kept"})])
    failed = results(spark, [("a", "FAILED", "boom"), ("b", "FAILED", "late")], "status string, error string")
    state = ops.patch_failures(state, failed, "distcp_status")
    state = ops.mark_unprocessed(state, failed, "distcp_status", "not processed", eligible=F.col("discovery_status") == "COMPLETED")
    assert by_table(state, "distcp_status", "overall_status", "error_message") == {
        "a": ("FAILED", "FAILED", "boom"),
        "b": ("COMPLETED", None, None),
        "c": (None, None, None),
        "d": ("FAILED", "FAILED", "kept"),
    }


def test_copy_flags_follow_the_filter(spark):
    figures = {"source_file_count": 10, "source_total_size_bytes": 1000}
    state = ledger(spark, [("a", {**figures, "partition_filter": "dt>=1"}), ("b", figures)])
    found = results(spark, [(t, "COMPLETED", None, 995, 10, 500, 5) for t in "ab"], "status string, error string, size_after long, files_after long, bytes_transferred long, files_transferred long")
    got = by_table(ops.advance_copy(state, found), "file_count_match", "file_size_match", "overall_status")
    assert got == {"a": (False, False, "COPIED"), "b": (True, True, "COPIED")}


def test_upsert_and_replace(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    s = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, v string, w string")
    assert sorted(map(tuple, ops.merge_upsert(t, s, ["k"], ["v"]).collect())) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "Z")]
    assert sorted(map(tuple, ops.replace_keys(t, s, ["k"]).collect())) == [(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")]
    assert ops.duplicate_keys(t.unionAll(s), ["k"]).collect()[0].k == 2


def test_runs_without_rows_fail(spark):
    state = ledger(spark, [("a", {"overall_status": "VALIDATED"}), ("b", {"overall_status": "DATA_MISSING"})])
    listed = spark.createDataFrame([("run",), ("idle",)], "run_id string")
    copy = {r.run_id: (r.total, r.run_status) for r in ops.finalize_run(state, "copy", listed).collect()}
    assert copy == {"run": (2, "COMPLETED"), "idle": (0, "FAILED")}
    assert ops.finalize_run(state, "metadata").first().run_status == "COMPLETED_WITH_MISSING"


def test_null_flags_count_on_neither_side(spark):
    rows = [("a", {"row_count_match": True, "partition_count_match": True, "schema_match": None}), ("b", {"row_count_match": False})]
    state = ledger(spark, [(t, {**v, "validation_status": "COMPLETED"}) for t, v in rows])
    row = report.validation_summary(state).first()
    assert (row.tables_validated, row.tables_passed, row.tables_failed, row.row_count_mismatches, row.schema_mismatches) == (2, 0, 1, 1, 0)


def test_reconcile_message(spark):
    src = spark.createDataFrame([("t", 10, 3)], "table_name string, row_count long, partition_count long")
    dst = spark.createDataFrame([("t", 9, 3)], "table_name string, row_count long, partition_count long")
    cols = "table_name string, column_name string, data_type string"
    a = spark.createDataFrame([("t", c, "int") for c in "abcd"], cols)
    b = spark.createDataFrame([("t", "a", "int"), ("t", "b", "string"), ("t", "z", "int")], cols)
    row = reconcile.reconcile_tables(src, dst, reconcile.schema_verdict(reconcile.schema_diff(a, b))).first()
    assert row.error == (
        "Row count mismatch: source=10, dest=9; Schema differences: Type mismatch for b: int vs string; Missing column: c; Missing column: d; Extra column in dest: z"
    )
    assert row.schema_differences.endswith("Extra column in dest: z") and not row.schema_match
    upper = spark.createDataFrame([("t", "A", "INT")], cols)
    assert reconcile.schema_diff(a.where("column_name = 'a'"), upper, case_sensitive=False).count() == 0


def test_run_records(spark, work):
    assert len(LEDGERS) == 12 and len(ledger_schema("migration_table_status")) == 57
    spark.createDataFrame([], ledger_schema("migration_runs")).write.saveAsTable("default.test_runs")
    new = runs.start_run(spark, "default.test_runs", "migration_runs", "s.xlsx", "iceberg_", {"tracking_database": "t", "secret_key": "no"})
    row = spark.table("default.test_runs").first()
    assert row.run_id == new and row.status == "RUNNING" and row.total_tables == 0 and row.config_json == '{"tracking_database": "t"}'
    import re

    assert re.fullmatch(r"iceberg_run_\d{8}_\d{6}_[0-9a-f]{8}", new)
    spark.sql("DROP TABLE default.test_runs")
