"""Work that must be done once, or stay small, however large the input."""

import os

from lakeshift.functions import partitions as P


def test_partition_string_is_split_once(spark):
    df = spark.createDataFrame([("a=1/b=%2F/a=2",)], "p string").select(P.partition_map("p").alias("m"), P.partition_value("p", "a").alias("a"))
    row = df.first()
    assert row.m == {"a": "2", "b": "/"} and row.a == "2"
    for c in (P.partition_map("p"), P.partition_value("p", "a")):
        assert str(c).count("split(") == 1


def test_whole_partitions_are_written_without_a_sort(spark, work, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from lakeshift.sources.tables import write_whole_partitions

    setting, seen, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save

    def spy(self, *args, **options):
        seen.append(int(spark.conf.get(setting, "0")))
        return save(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "save", spy)
    before = spark.conf.get(setting, None)
    rows = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 AS k")
    write_whole_partitions(rows, f"{work}/t", ["k"])
    assert seen and min(seen) > 0 and spark.conf.get(setting, None) == before
    for k in range(3):
        assert len([f for f in os.listdir(f"{work}/t/k={k}") if f.endswith(".parquet")]) == 1
    assert spark.read.parquet(f"{work}/t").count() == 1000


def test_compiled_policies_are_stored_once(spark):
    from lakeshift.plans import policy_run

    columns = ["role", "database", "tables", "columns", "url", "permissions", "groups", "users", "rowfilter", "policy_label", "item_type"]
    sheet = spark.createDataFrame([("s", 1, "r", "d", "t, u", None, None, "read", "g", "a, b", None, " x ,y", None)], "sheet_id string, row_index long, " + ", ".join(f"`{c}` string" for c in columns))
    compiled = policy_run.compile_sheet(sheet)
    assert compiled.members is compiled.members and all("policy_members" in f for f in compiled.members.inputFiles())
    assert {(r.policy_name, tuple(r.labels)) for r in compiled.headers.collect()} == {("iceberg.d.t", ("x", "y")), ("iceberg.d.u", ("x", "y"))}


def test_metadata_sheet_is_parsed_once(spark):
    from lakeshift.plans import metadata

    columns = ["database", "table", "dest_database", "dest_bucket", "source_s3_prefix", "dest_s3_prefix", "source_table_path"]
    sheet = spark.createDataFrame([(1, "d", "t", None, None, None, None, "s3://b/t")], "row_index long, " + ", ".join(f"`{c}` string" for c in columns))
    found = metadata.planned_tables("iceberg", sheet, "s3a://lake")
    assert [r.location for r in found.collect()] == ["s3a://b/t"]
    assert found.inputFiles() and all("parsed_sheet" in f for f in found.inputFiles())


def test_rules_share_tests_and_sorts_do_not_scan_twice(spark):
    from lakeshift.functions.text import shared_parts
    from lakeshift.operators import scan

    groups = shared_parts([["hive.exec"], ["hive.x", "y.hive."], ["print"], []])
    assert [(p, sorted(n)) for p, n in groups] == [("hive.", [0, 1]), (None, [2, 3])]
    issues = spark.createDataFrame([("b", 2, "R", "t", "low", "c", "x"), ("a", 1, "R", "t", "low", "c", "x")], "path string, line_number int, rule_id string, title string, severity string, category string, line_text string")
    ordered = scan.ordered_issues(issues, "category")
    assert [r.path for r in ordered.collect()] == ["a", "b"]
    assert ordered.inputFiles() and all("/issues-" in f for f in ordered.inputFiles())


def test_import_chain_stands_once_in_a_finding(spark):
    from pyspark.sql import functions as F

    from lakeshift.operators import rewrite

    chain, findings = (str(c).count("import of ") for c in (rewrite.import_finding(F.col("s")), rewrite._findings(F.col("s"))))
    assert 0 < findings == chain
    found = rewrite.rewrite_findings(spark.createDataFrame([("f", "x = 1\r\nt = DummyOperator(fail_stop=1)")], "path string, content string"))
    assert [(r.line_number, r.category) for r in found.orderBy("finding_number").collect()] == [(2, "DAG Parameters"), (2, "Operator Rename")]


def test_policy_rows_are_spread_from_their_lists_and_listed_in_one_pass(spark, column):
    from lakeshift.functions import cells as C
    from lakeshift.operators import policy
    from lakeshift.plans import policy_run

    cells = ["a , , b", "　x,\ty\n", " nan ", ",", "a b,c", "nan,", None]
    assert column(C.csv_array, cells) == [["a", "b"], ["x", "y"], [], [], ["a b", "c"], ["nan"], []]
    assert "lambda" not in str(C.csv_array("c"))
    columns = ["role", "database", "tables", "columns", "url", "permissions", "groups", "users", "rowfilter", "policy_label", "item_type"]
    rows = [("s", 1, "r", "d", "t", None, None, "read", "g", "a, b", "x = 1", None, None), ("s", 2, "q", "d", "t", None, None, "write", None, "b", None, None, None)]
    compiled = policy_run.compile_sheet(spark.createDataFrame(rows, "sheet_id string, row_index long, " + ", ".join(f"`{c}` string" for c in columns)))
    assert all("policy_checked" in f for f in compiled.exploded.inputFiles())
    initial = policy.policy_initial_status(compiled.members)
    assert initial._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    (row,) = initial.collect()
    assert (row.users, row.groups, row.permissions, row.rowfilter) == (["a", "b"], ["q", "r"], ["read", "write"], "x = 1")
