import os

from pyspark.sql import functions as F

from lakeshift.operators import files as ops
from lakeshift.sources import catalog, files, tables


def write(root, names):
    for name, body in names.items():
        os.makedirs(os.path.dirname(f"{root}/{name}") or root, exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(body)


def listing(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n)).read() for d, _, ns in os.walk(root) for n in ns if not n.startswith(".")}


def test_mirror_and_additive_file_copies(spark, work):
    src, dst = f"{work}/src", f"{work}/dst"
    write(src, {"dt=1/a.bin": "aaa", "dt=2/b c.bin": "bb", "top.bin": "t"})
    write(dst, {"dt=1/a.bin": "old!", "dt=9/x.bin": "x", "top.bin": "t"})
    manifest = files.file_manifest(spark, src)
    assert {(r.rel_path, r.partition, r.length) for r in manifest.collect()} == {("dt=1/a.bin", "dt=1", 3), ("dt=2/b c.bin", "dt=2", 2), ("top.bin", "", 1)}
    assert "content" not in manifest._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    plan = ops.copy_plan(manifest, files.file_manifest(spark, dst))
    assert {r.rel_path: r.action for r in plan.collect()} == {"dt=1/a.bin": "CHANGED", "dt=2/b c.bin": "NEW", "dt=9/x.bin": "EXTRA", "top.bin": "SAME"}
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    copied = {r.rel_path: r.bytes_copied for r in files.copy_files(plan, src, dst).collect()}
    assert copied == {"dt=1/a.bin": 3, "dt=2/b c.bin": 2}
    assert listing(dst) == {"dt=1/a.bin": "aaa", "dt=2/b c.bin": "bb", "dt=9/x.bin": "x", "top.bin": "t"}
    assert files.delete_extra(plan, dst).count() == 1
    assert listing(dst) == listing(src)


def test_presence_and_folder_check(spark):
    inventory = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", "p3"), ("d", None), ("e", "p5")], "t string, dest_path string")
    summary = spark.createDataFrame([("p1", 2, 10, None), ("p2", 0, 0, None), ("p5", 1, 1, "denied")], "root string, file_count long, size_bytes long, error string")
    got = {r.t: (r.status, r.file_count) for r in ops.data_presence(inventory, summary).collect()}
    assert got == {"a": ("CONFIRMED", 2), "b": ("MISSING", 0), "c": ("MISSING", 0), "d": ("MISSING", 0), "e": ("FAILED", 0)}
    copies = spark.createDataFrame([("p1", "COMPLETED", 2, 10), ("p9", "COMPLETED", 0, 0), ("p1", "FAILED", 2, 10), ("p1", "COMPLETED", 3, 10)], "dest_path string, status string, source_file_count long, source_size_bytes long")
    states = sorted(r.validation_status for r in ops.folder_verify(copies, summary).collect())
    assert states == ["VALIDATED", "VALIDATION_FAILED", "VALIDATION_FAILED", "VALIDATION_SKIPPED"]


def test_partition_copy_leaves_others_alone(spark, work):
    df = spark.range(40).selectExpr("id", "id % 4 AS k")
    tables.copy_partitions(df, f"{work}/t", ["k"])
    tables.copy_partitions(df.where("k = 1").withColumn("id", F.col("id") + 1000), f"{work}/t", ["k"])
    got = spark.read.parquet(f"{work}/t")
    assert got.count() == 40 and got.where("k = 1 AND id >= 1000").count() == 10 and got.where("id >= 1000").count() == 10


def test_additive_table_copy(spark, work):
    spark.range(5).write.parquet(f"{work}/t")
    tables.copy_table(spark.range(3, 8), f"{work}/t", mode="additive", keys=["id"])
    assert sorted(r.id for r in spark.read.parquet(f"{work}/t").collect()) == list(range(8))
    tables.copy_table(spark.range(2), f"{work}/t")
    assert spark.read.parquet(f"{work}/t").count() == 2


def test_catalog_round_trip(spark, work):
    catalog.ensure_databases(spark, ["mig", "mig"])
    spark.sql(f"CREATE TABLE mig.src (id BIGINT, ts TIMESTAMP, dt STRING) USING parquet PARTITIONED BY (dt) LOCATION '{work}/src'")
    spark.sql("INSERT INTO mig.src SELECT id, current_timestamp(), concat('2024-01-0', id % 3 + 1) FROM range(9)")
    assert [r.table_name for r in catalog.list_tables(spark, "mig").collect()] == ["src"]
    assert catalog.partition_columns(spark, "mig", "src") == ["dt"]
    assert sorted(r[0] for r in catalog.list_partitions(spark, "mig", "src").collect()) == [f"dt=2024-01-0{i}" for i in (1, 2, 3)]
    facts = catalog.describe_table(spark, "mig", "src").first()
    assert facts.location.endswith("/src") and facts.table_type == "EXTERNAL" and facts.file_format == "PARQUET"

    schema = [{"name": r.column_name, "type": r.data_type} for r in catalog.table_columns(spark, "mig", ["src"]).orderBy("ordinal").collect()]
    assert catalog.create_external_table(spark, "mig", "dst", schema, ["dt"], "PARQUET", f"{work}/src") is False
    assert catalog.create_external_table(spark, "mig", "dst", schema, ["dt"], "PARQUET", f"{work}/src") is True
    assert catalog.unregistered_partitions(spark, "mig", "dst")
    catalog.add_partitions(spark, "mig", "dst", ["dt=2024-01-02"], f"{work}/src")
    assert spark.table("mig.dst").count() == 3
    catalog.repair_table(spark, "mig", "dst")
    assert spark.table("mig.dst").count() == 9 and not catalog.unregistered_partitions(spark, "mig", "dst")

    assert tables.convert_table(spark, "mig.src", "mig.copy", ["dt"], "orc") == "mig.copy"
    assert tables.convert_table(spark, "mig.src", "mig.copy", ["dt"], "orc") == "mig.copy"
    assert spark.table("mig.copy").count() == 9 and catalog.describe_table(spark, "mig", "copy").first().file_format == "ORC"
    tables.convert_table(spark, "mig.copy", partition_by=["dt"], fmt="parquet")
    assert spark.table("mig.copy").count() == 9 and catalog.describe_table(spark, "mig", "copy").first().file_format == "PARQUET"
    assert catalog.register_table(spark, "mig", "reg", f"{work}/src") == "registered"
    assert catalog.register_table(spark, "mig", "reg", f"{work}/src") == "refreshed"
    tables.replace_table(spark.table("mig.copy").where("id < 4"), "mig.copy", ["dt"])
    assert spark.table("mig.copy").count() == 4
    spark.sql("DROP DATABASE mig CASCADE")


def test_ledger_tables(spark):
    from lakeshift.schemas import LEDGERS, ledger_schema

    schemas = {n: ledger_schema(n) for n in LEDGERS}
    for _ in range(2):
        catalog.ensure_ledger(spark, "track", schemas)
    assert {t.name for t in spark.catalog.listTables("track")} == set(LEDGERS)
    assert catalog.partition_columns(spark, "track", "migration_table_status") == ["source_database"]
    spark.sql("DROP DATABASE track CASCADE")


def test_text_table_ddl(spark, work):
    props = {"field.delim": "|", "escape.delim": "\\", "null.format": "N'A"}
    assert catalog.row_format_clause("TEXTFILE", props) == (
        "ROW FORMAT DELIMITED FIELDS TERMINATED BY '|' ESCAPED BY '\\\\'", "TBLPROPERTIES ('serialization.null.format'='N\\'A')",
    )
    assert catalog.row_format_clause("PARQUET", props) == ("", "")
    assert catalog.row_format_clause("TEXTFILE", {"escape.delim": "x"}) == ("", "")
    columns, parts = catalog.ddl_columns([{"name": "a", "type": "timestamp_ntz"}, {"name": "p", "type": "int"}], ["p", "q"])
    assert (columns, parts) == ("`a` timestamp", "`p` int, `q` STRING")
    ddl = catalog.external_table_ddl("`d`.`t`", [{"name": "a", "type": "int"}], ["p"], "TEXTFILE", "s3a://b/t", props)
    assert ddl.startswith("CREATE EXTERNAL TABLE IF NOT EXISTS `d`.`t` (`a` int) PARTITIONED BY (`p` STRING) ROW FORMAT DELIMITED")
    write(work, {"x.txt": "1|a\\|b\n2|N'A\n"})
    got = tables.read_table_files(spark, "TEXTFILE", work, "id int, v string", props).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a|b"), (2, None)]


def test_metadata_documents(spark):
    import json

    from lakeshift.operators import table_metadata as ops

    doc = {
        "current-schema-id": 1,
        "schemas": [{"schema-id": 0, "fields": []}, {"schema-id": 1, "fields": [
            {"id": 1, "name": "id", "required": True, "type": "long"}, {"id": 2, "name": "day", "required": False, "type": "date"},
            {"id": 3, "name": "p", "required": False, "type": "decimal(9,2)"}, {"id": 4, "name": "s", "required": False, "type": {"type": "list"}}]}],
        "default-spec-id": 5, "partition-specs": [{"spec-id": 0, "fields": [{"source-id": 2, "field-id": 1000, "name": "d", "transform": "identity"}, {"source-id": 77, "field-id": 1001, "name": "x", "transform": "identity"}]}],
        "current-snapshot-id": 2, "snapshots": [{"snapshot-id": 2, "summary": {"total-records": "42"}}],
    }
    df = spark.createDataFrame([("t", json.dumps(doc)), ("e", "{}")], "name string, metadata string")
    got = {r.name: r for r in ops.table_facts(df).collect()}
    assert [tuple(f) for f in got["t"].schema_fields] == [("id", "BIGINT"), ("day", "DATE"), ("p", "DECIMAL(9,2)"), ("s", "STRING")]
    assert got["t"].partition_columns == ["day", "field_77"] and got["t"].row_count == 42
    assert got["e"].schema_fields == [] and got["e"].partition_columns == [] and got["e"].row_count == 0
    names = [("t", "v9.metadata.json"), ("t", "v10.metadata.json"), ("t", "snap.avro"), ("u", "00002-x.metadata.json"), ("u", "00001-y.metadata.json")]
    files_df = spark.createDataFrame(names, "table_path string, file_name string")
    hints = spark.createDataFrame([("h", "3"), ("u", "1 ")], "table_path string, version string")
    assert {r.table_path: r.file_name for r in ops.latest_metadata(files_df, hints).collect()} == {"t": "v10.metadata.json", "u": "v1.metadata.json", "h": "v3.metadata.json"}
