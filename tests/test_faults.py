"""Shapes that once gave wrong or no results."""

import pytest

from lakeshift.functions import cells as C
from lakeshift.functions import partitions as P
from lakeshift.operators import control, ledger
from lakeshift.plans import copy_run
from lakeshift.sources import scratch
from lakeshift.sources import tables as sink

TABLE = "run_id string, source_database string, source_table string, dest_database string"


def test_one_table_planned_twice_keeps_both_filters(spark):
    planned = spark.createDataFrame(
        [("d", "t", "A", "b1", "e", "last_n_partitions=2"), ("d", "t", "B", "b2", "e", "last_n_partitions=4"), ("d", "t", "C", "b1", None, "p<=2")],
        "source_database string, table_name string, dest_database string, dest_bucket string, dest_endpoint string, partition_filter string",
    )
    parts = spark.createDataFrame([("d", "t", f"p={i}") for i in range(1, 7)], "source_database string, table_name string, partition string")
    got = sorted((r.dest_database, r.partition) for r in copy_run.planned_partitions(planned, parts).collect())
    assert got == [("A", "p=5"), ("A", "p=6"), *[("B", f"p={i}") for i in (3, 4, 5, 6)], ("C", "p=1"), ("C", "p=2")]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_additive_copy_takes_new_values(spark, work, by):
    cols = "k int, v string, g string"
    spark.createDataFrame([(1, "old", "x"), (2, "stays", "y")], cols).write.parquet(f"{work}/t") if not by else spark.createDataFrame(
        [(1, "old", "x"), (2, "stays", "y")], cols
    ).write.partitionBy("g").parquet(f"{work}/t")
    sink.copy_table(spark.createDataFrame([(1, "new", "x"), (3, "more", "y")], cols), f"{work}/t", mode="additive", keys=["k"], partition_by=by)
    assert sorted((r.k, r.v, r.g) for r in spark.read.parquet(f"{work}/t").collect()) == [(1, "new", "x"), (2, "stays", "y"), (3, "more", "y")]


def test_repeated_source_keys_fail_an_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than once: 1"):
        ledger.merge_upsert(target, twice, ["k"]).collect()
    with pytest.raises(Exception, match="more than once: 1"):
        ledger.apply_results(target, twice, ["k"], {"v": ledger.F.col("r_v")}).collect()


def test_gates_do_not_multiply_tables(spark):
    tables = spark.createDataFrame([("r", "d", "t", "x"), ("r", "d", "u", "x")], TABLE)
    keys = ["source_database", "source_table"]
    found = spark.createDataFrame([("d", "t", "CONFIRMED"), ("d", "t", "MISSING"), ("d", "u", "CONFIRMED"), ("d", "u", "CONFIRMED")], "source_database string, source_table string, status string")
    gates = {r.source_table: (r.data_presence_status, r.gate) for r in ledger.presence_gate(tables, found, keys).collect()}
    assert gates == {"t": ("MISSING", "SKIPPED"), "u": ("CONFIRMED", "READY")} and ledger.presence_gate(tables, found, keys).count() == 2
    state = spark.createDataFrame([("r", "d", "t", "x", s, None, "RUNNING", "e") for s in ("COMPLETED", "FAILED")], TABLE + ", distcp_status string, table_create_status string, overall_status string, error_message string")
    assert sorted((r.source_table, r.gate) for r in ledger.validation_gate(tables, state).collect()) == [("t", "SKIPPED"), ("u", "READY")]


def test_odd_tokens_and_repeated_keys_do_not_end_the_run(spark, column):
    tokens = spark.createDataFrame([("d", "t(*", 1), ("d", "a.b* | c*", 2)], "source_database string, token string, position int")
    tables = spark.createDataFrame([("d", n) for n in ("t(1", "t1", "a.b1", "axb1", "C9")], "source_database string, table_name string")
    assert {r.table_name for r in control.resolve_tokens(tokens, tables).collect()} == {"t(1", "a.b1", "C9"}
    assert column(P.partition_map, ["k=1/k=2/j=3"]) == [{"k": "2", "j": "3"}]
    assert column(C.serde_properties, ["[field.delim=a, field.delim=b]"]) == [{"field.delim": "b"}]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Cluster(), "x")
