"""Runs over versioned ledgers, inventories, metadata on storage, and writers that touch no more than they must."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from lakeshift.sources import footers, inventory, metadata, storage, tables, versioned
from lakeshift.workload import runs


def plain(df, *leave_out):
    return sorted((tuple(v for k, v in sorted(r.asDict().items()) if k not in leave_out) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- versioned tables


def test_versions_are_made_once(spark, work):
    t = versioned.VersionedTable(spark, f"{work}/v", "k string, n int")
    assert t.version() == 0 and t.read().count() == 0
    rows = spark.createDataFrame([("a", 1)], "k string, n long")
    assert t.commit(rows, 0) == 1 and t.read().schema.simpleString() == "struct<k:string,n:int>"
    with pytest.raises(versioned.Conflict):
        t.commit(rows, 0)
    assert len(os.listdir(f"{work}/v/rows")) == 1  # rows of the loser are gone
    t.commit(spark.createDataFrame([("b", 2)], "k string, n int"), 1)
    assert plain(t.read()) == [("b", 2)] and plain(t.read(1)) == [("a", 1)]


def test_two_writers_lose_no_change(spark, work, monkeypatch):
    monkeypatch.setattr(versioned, "PAUSES", (0.01,))
    t = versioned.VersionedTable(spark, f"{work}/v", "k string, n int")
    t.commit(spark.createDataFrame([(str(i), 0) for i in range(4)], "k string, n int"), 0)
    gate = threading.Barrier(4)

    def add(i):
        gate.wait()
        t.update(lambda rows: rows.withColumn("n", F.when(F.col("k") == str(i), F.col("n") + 1).otherwise(F.col("n"))), tries=20)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(4)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert t.version() == 5 and plain(t.read()) == [(str(i), 1) for i in range(4)]


def test_a_file_is_created_once(spark, work):
    path = f"{work}/one/file"
    assert storage.create_new(spark, path, "x") and not storage.create_new(spark, path, "y")
    assert storage.read_text(spark, path) == "x" and storage.names(spark, f"{work}/one") == ["file"]
    assert storage.content_summary(spark, f"{work}/one") == (1, 1) and storage.content_summary(spark, f"{work}/none") == (0, 0)


# ---------------------------------------------------------------- runs

FEW = [("lineitem", "lake_a", "l_returnflag=A/*"), ("customer_building, gone", "lake_b", None)]


def test_a_run_that_stops_goes_on_where_it_was(spark, small):
    whole = runs.planned_copy(spark, small, FEW)
    want = plain(runs.run_result(whole.run(), whole.finalize()))
    stopped = runs.planned_copy(spark, small, FEW)
    seen = []
    for stage in ("discover", "copy", "create", "validate"):
        stopped.run(stop_after=stage)
        seen.append(stopped.ledger.version())
    assert seen == [1, 2, 3, 4]
    assert plain(runs.run_result(stopped.ledger.read(), stopped.finalize())) == want
    stopped.run()
    assert stopped.ledger.version() == 4  # nothing is due any more


def test_a_run_lost_within_a_stage_does_it_again(spark, small, monkeypatch):
    run = runs.planned_copy(spark, small, FEW)
    run.run(stop_after="discover")
    monkeypatch.setattr(versioned.VersionedTable, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run.run(stop_after="copy")  # files are copied, the ledger does not know
    monkeypatch.undo()
    out = run.run()
    rows = out.where("source_table <> 'gone'").collect()
    assert {r.validation_status for r in rows} == {"COMPLETED"} and all(r.distcp_is_incremental for r in rows)
    assert {r.overall_status for r in rows if not (r.partition_filter or "").strip()} == {"VALIDATED"}


def test_a_table_that_cannot_be_copied_fails_alone(spark, small, monkeypatch):
    run = runs.planned_copy(spark, small, FEW)
    keep = type(run)._copy
    monkeypatch.setattr(type(run), "_copy", lambda self, row: 1 / 0 if row.source_table == "lineitem" else keep(self, row))
    state = {r.source_table + r.dest_database[:6]: r for r in run.run().collect()}
    bad = state["lineitemlake_a"]
    assert (bad.distcp_status, bad.table_create_status, bad.validation_status, bad.overall_status) == ("FAILED", "SKIPPED", None, "FAILED")
    assert "division" in bad.error_message and state["customer_buildinglake_b"].overall_status == "VALIDATED"
    assert run.finalize().first().failed == 2


# ---------------------------------------------------------------- inventory and footers


def test_counts_come_from_footers(spark, work):
    path = f"{work}/t"
    spark.range(100).selectExpr("id", "id % 3 AS p", "if(id % 7 = 0, NULL, id % 2) AS q").write.partitionBy("p", "q").parquet(path)
    session = footers.footer_session(spark)
    counts = footers.row_counts(session, path, "parquet", ["p", "q"])
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    assert plain(counts) == plain(spark.read.parquet(path).groupBy("p", "q").agg(F.count("*").alias("row_count")))
    one = footers.row_counts(session, path, "parquet", ["p", "q"], F.col("p") == 2)
    assert "PushedAggregation: [COUNT(*)]" in one._jdf.queryExecution().executedPlan().toString() and sum(r.row_count for r in one.collect()) == 33
    assert footers.row_counts(session, path, "parquet", where=F.col("id") < 10).first().row_count == 10  # a scan, as exact
    assert spark.conf.get("spark.sql.sources.useV1SourceList", "parquet") != session.conf.get("spark.sql.sources.useV1SourceList")
    ref = inventory.TableRef("d", "t", path, "PARQUET", (("id", "bigint"), ("p", "bigint"), ("q", "bigint")), ("p", "q"))
    broken = inventory.TableRef("d", "broken", f"{work}/broken", "PARQUET", (("id", "bigint"),))
    os.makedirs(f"{work}/broken")
    with open(f"{work}/broken/part-0.parquet", "w") as f:
        f.write("no parquet")
    wanted = spark.createDataFrame([("d", "t", "last_n_partitions=2, p=0/q=1")], "source_database string, source_table string, partition_filter string")
    out = {r.source_table: r for r in inventory.inventory(spark, [ref, broken], wanted).collect()}
    t = out["t"]
    assert (t.partition_count, t.row_count, t.filter_active, t.error) == (9, 100, True, None)
    listed = plain(spark.read.parquet(path).groupBy("p", "q").count().where("(p = 0 AND q = 1) OR p = 2"))
    kept = {("0", "1"), ("2", None), ("2", "1")}  # the greatest names: p=2/q=__HIVE..., p=2/q=1
    assert t.filtered_partition_count == 3 and t.filtered_row_count == sum(n for n, p, q in listed if (str(p), None if q is None else str(q)) in kept)
    assert json.loads(t.schema_json)[2] == {"name": "q", "type": "bigint"}
    assert out["broken"].row_count == 0 and "cannot be read" in out["broken"].error


# ---------------------------------------------------------------- metadata on storage


def test_current_documents_and_what_cannot_be_read(spark, work):
    root = f"{work}/tables"
    names = {"new": ["v9.metadata.json", "v10.metadata.json", "x.metadata.json", "v11.avro"], "uuid": ["00002-b.metadata.json", "00010-a.metadata.json"], "odd": ["v1.metadata.json"]}
    rows = [(f"{root}/{t}", n, json.dumps({"n": n})) for t, files in names.items() for n in files]
    rows += [(f"{root}/hint", "v2.metadata.json", "{}"), (f"{root}/hint", "v3.metadata.json", "{}"), (f"{root}/hint", "version-hint.text", " 2 \n")]
    rows += [(f"{root}/blank", "version-hint.text", ""), (f"{root}/list", "v1.metadata.json", "[1]"), (f"{root}/bad", "v1.metadata.json", "{")]
    assert metadata.write_documents(spark.createDataFrame(rows, "table_path string, file_name string, content string")) == len(rows)
    wanted = [*sorted({r[0] for r in rows}), f"{root}/none", None, f"file://{root}/new/"]
    asked = spark.createDataFrame([(i, p, "mine") for i, p in enumerate(wanted)], "id int, table_path string, error string")
    out = {r.table_path: r for r in metadata.read_table_facts(asked).collect()}
    assert len(out) == len(wanted)
    assert {k.rsplit("/", 1)[-1]: r.metadata_file for k, r in out.items() if k and r.error is None} == {
        "new": "v10.metadata.json", "uuid": "00010-a.metadata.json", "odd": "v1.metadata.json", "hint": "v2.metadata.json", "": "v10.metadata.json"
    }
    errors = {(k or "null").rsplit("/", 1)[-1]: r.error for k, r in out.items() if r.error}
    assert errors == {
        "blank": "hinted document does not exist: v.metadata.json", "list": "not a JSON document: v1.metadata.json", "bad": "not a JSON document: v1.metadata.json",
        "none": "no metadata folder", "null": "no path",
    }
    assert metadata.read_documents(asked.limit(0)).collect() == []


# ---------------------------------------------------------------- writers


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_an_additive_copy_leaves_other_partitions_alone(spark, work):
    dest = f"{work}/dest"
    old = [(1, "a", "01"), (2, "b", "01"), (3, "c", "02"), (4, "d", None), (5, "e", "03"), (None, "n", "04")]
    kind = "k int, v string, p string"
    tables.copy_table(spark.createDataFrame(old, kind), dest, partition_by=["p"])
    before = _files(dest)
    new = [(3, "C", "05"), (2, "B", "01"), (9, "z", None)]
    tables.copy_table(spark.createDataFrame(new, kind), dest, mode="additive", partition_by=["p"], keys=["k"])
    got = spark.read.schema(kind).parquet(dest)
    assert plain(got) == sorted([(1, "01", "a"), (2, "01", "B"), (3, "05", "C"), (4, None, "d"), (5, "03", "e"), (9, None, "z"), (None, "04", "n")], key=repr)
    kept = {f for f in before if f.startswith(("p=03", "p=04"))}
    assert kept and kept <= _files(dest) and not any(f.startswith("p=02") for f in _files(dest))
    assert not {f for f in before if f.startswith("p=01")} & _files(dest)
    tables.copy_table(spark.createDataFrame([], kind), dest, mode="additive", partition_by=["p"], keys=["k"])
    assert got.count() == 7


def test_a_partition_emptied_at_the_source_goes(spark, work):
    dest = f"{work}/dest"
    rows = [(i, f"x {i % 4}" if i % 5 else None, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, p string, q int")
    tables.copy_partitions(df, dest, ["p", "q"])
    now = df.where("coalesce(p, '') <> 'x 1' AND p IS NOT NULL")
    tables.copy_partitions(now, dest, ["p", "q"], within=F.col("q") == 1)
    want = [r for r in rows if r[2] == 0 or (r[1] is not None and r[1] != "x 1")]
    assert sorted(r.k for r in spark.read.parquet(dest).collect()) == sorted(r[0] for r in want)


@pytest.mark.parametrize("step", range(4))
def test_a_replacement_lost_on_the_way_leaves_a_whole_table(spark, monkeypatch, step):
    name = f"swap_{step}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    table = f"{name}.t"
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").format("orc").saveAsTable(table)
    sql, lost = type(spark).sql, []

    def failing(self, text, *a, **k):
        if text.startswith(("ALTER", "DROP TABLE IF EXISTS " + table + "__last")):
            lost.append(text)
            if len(lost) == step + 1 + (1 if step > 2 else 0):
                raise RuntimeError("lost")
        return sql(self, text, *a, **k)

    # nothing is lost by finish_replacement itself here, as there is nothing to finish
    monkeypatch.setattr(tables, "finish_replacement", lambda *a: None)
    monkeypatch.setattr(type(spark), "sql", failing)
    try:
        tables.convert_table(spark, table, partition_by=["p"], fmt="parquet")
    except RuntimeError:
        pass
    monkeypatch.undo()
    whole = [n for n in (table, f"{table}__next", f"{table}__last") if spark.catalog.tableExists(n)]
    assert any(spark.table(n).count() == 10 for n in whole if n != f"{table}__last")
    tables.finish_replacement(spark, table)
    assert [t.name for t in spark.catalog.listTables(name)] == ["t"] and spark.table(table).count() == 10
    tables.convert_table(spark, table, partition_by=["p"], fmt="parquet")
    provider = [r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r.col_name == "Provider"]
    assert len([n for n in os.listdir(spark.catalog.getDatabase(name).locationUri.removeprefix("file:")) if n.startswith("t-")]) == 1
    assert provider == ["parquet"] and plain(spark.table(table)) == [(i, i % 2) for i in range(10)]


def test_metadata_and_conversion_runs_go_on_where_they_stopped(spark, small):
    run = runs.planned_metadata(spark, small)
    for n, stage in enumerate(("discover", "presence", "create", "validate"), 1):
        run.run(stop_after=stage)
        assert run.ledger.version() == n
    states = {r.source_table: r.overall_status for r in run.run().collect()}
    assert run.ledger.version() == 4
    assert states["customer_machinery"] == "DATA_MISSING" and states["customer_building"] == "VALIDATION_FAILED" and states["lineitem"] == "VALIDATED"
    assert (run.finalize().first().missing, run.finalize().first().run_status) == (1, "COMPLETED_WITH_FAILURES")
    run = runs.planned_conversion(spark, small)
    run.run(stop_after="convert")
    run.run()
    assert run.ledger.version() == 3 and {r.status for r in run.ledger.read().where("source_table <> 'gone'").collect()} == {"VALIDATED"}
