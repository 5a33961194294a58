import fnmatch
import itertools

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import control as ops
from lakeshift.operators import windows
from lakeshift.plans import copy_run
from lakeshift.sources import sheets


def test_sheet_files(spark, work):
    with open(f"{work}/a.csv", "w") as f:
        f.write(" DataBase ,Table,Dest Database,partition_filter\nsales,\"t1, t2\",,\n,x,,\n nan ,y,,\nhr,*,lake,last_n_partitions=2\n")
    sheet = sheets.read_control_sheet(spark, f"{work}/a.csv", sheets.COPY_COLUMNS)
    parsed = ops.parse_copy_control(sheet, "s3://default").orderBy("row_index").collect()
    assert [(r.row_index, r.source_database, r.table_cell, r.dest_database, r.dest_bucket, r.partition_filter) for r in parsed] == [
        (0, "sales", "t1, t2", "sales", "s3a://default", None),
        (3, "hr", "*", "lake", "s3a://default", "last_n_partitions=2"),
    ]


def test_groups_keep_order_and_collapse_to_star(spark):
    rows = [(0, "a", "t2, t1"), (1, "a", "t1,t3,"), (2, "b", "x"), (3, "b", "*, y"), (4, "b", "z")]
    df = spark.createDataFrame(rows, "row_index long, db string, table_cell string")
    got = {r.db: r.table_tokens for r in ops.group_control(df, ["db"]).collect()}
    assert got == {"a": ["t2", "t1", "t3"], "b": ["*"]}


TABLES = ["orders", "orders_2023", "Orders_2024", "lines", "a[b", "x.y"]


def _resolve(spark, tokens, strict):
    t = spark.createDataFrame([("d", tok, i) for i, tok in enumerate(tokens)], "source_database string, token string, position int")
    c = spark.createDataFrame([("d", x) for x in TABLES] + [("other", "orders")], "source_database string, table_name string")
    return {(r.table_name, r.position) for r in ops.resolve_tokens(t, c, strict=strict).collect()}


def test_loose_tokens_match_like_the_catalog(spark):
    assert _resolve(spark, ["ghost", "orders_*", "orders"], False) == {("ghost", 0), ("orders_2023", 1), ("Orders_2024", 1), ("orders", 2)}
    assert {t for t, _ in _resolve(spark, ["*"], False)} == set(TABLES)


def test_strict_tokens_match_like_a_shell(spark):
    for pattern in ("orders*", "*_202?", "[ol]*", "[!o]*", "x.y", "x?y", "a[[]b"):
        want = {(t, 0) for t in TABLES if fnmatch.fnmatchcase(t, pattern)}
        assert _resolve(spark, [pattern], True) == want, pattern
    assert _resolve(spark, ["ghost", "lines"], True) == {("lines", 1)}


def test_many_patterns_split_into_lists(spark):
    tokens = [f"p{i}*" for i in range(1200)] + ["*_2023"]
    assert _resolve(spark, tokens, False) == {("orders_2023", 1200)}


def test_planned_tables(spark):
    rows = [(0, "d", "ord*", None, None, None, "dt>=1"), (1, "d", "lines", "lake", "s3://b", None, None)]
    sheet = spark.createDataFrame(rows, "row_index long, database string, `table` string, dest_database string, bucket string, endpoint string, partition_filter string")
    tables = spark.createDataFrame([("d", t) for t in TABLES], "source_database string, table_name string")
    got = {(r.table_name, r.dest_database, r.partition_filter) for r in copy_run.planned_tables(sheet, tables, "s3a://x").collect()}
    assert got == {("orders", "d", "dt>=1"), ("orders_2023", "d", "dt>=1"), ("Orders_2024", "d", "dt>=1"), ("lines", "lake", None)}


def test_first_and_last_rows(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "z")], "k string, n int, v string")
    assert sorted(map(tuple, windows.distinct_first(df, ["k"], "n").collect())) == [("a", 1, "x"), ("b", 5, "z")]
    assert ("a", 2, None) in set(map(tuple, windows.last_per_group(df, ["k"], "n").collect()))


def test_endpoints(spark):
    df = spark.createDataFrame([("s3a://B/x", "https://h-1.x:9"), ("s3a://B/x", "https://h-1.x:9 ")], "dest_bucket string, dest_endpoint string")
    assert [tuple(r) for r in ops.distinct_endpoints(df).collect()] == [("s3a://B/x", "https://h-1.x:9", "b", "H_1_X")]


def test_sheets_of_many_splits_number_rows_as_pandas_does(spark, work):
    import io
    import os
    import random

    import pandas as pd

    rng = random.Random(2)
    cells = ["a", "", "x y", '"q"', '"two\nlines"', '"a,b"', '"say ""hi"""', '"\n\n,\n"', "nan", " pad ", "é", '"cr\r\nlf"']
    texts = {"one.csv": "Database, Table ,BUCKET\n", "two.csv": "﻿table,Partition Filter,database\r\n", "head.csv": "database,table\n", "short.csv": "database,table,bucket\nd\n\n  \nd2,t2\n"}
    for name, end in (("one.csv", "\n"), ("two.csv", "\r\n")):
        for i in range(700):
            texts[name] += ",".join([f"d{i}", rng.choice(cells), rng.choice(cells)]) + end + (end if rng.random() < 0.1 else "")
    texts["one.csv"] += "last,row,here"
    os.makedirs(f"{work}/sheets")
    for name, text in texts.items():
        with open(f"{work}/sheets/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    want = []
    for name, text in texts.items():
        sheet = pd.read_csv(io.BytesIO(text.encode()), dtype=str, keep_default_na=False)
        names = [c.strip().lower().replace(" ", "_") for c in sheet.columns]
        for i, r in enumerate(sheet.astype(object).where(sheet.notna(), None).itertuples(index=False)):
            row = dict(zip(names, r))
            want.append((f"file:{work}/sheets/{name}", i, *[row.get(c) for c in sheets.COPY_COLUMNS]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = sheets.read_control_sheet(spark, f"{work}/sheets", sheets.COPY_COLUMNS).collect()
        assert spark.read.text(f"{work}/sheets/one.csv").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_shell_patterns_equal_those_of_the_standard_library(spark):

    from lakeshift.operators.control import glob_pattern

    tokens = ["[z-a]*", "[!]*", "[!z-a]x", "[]a]b", "[!]a]b", "[a", "a]", "[a-c]?", "[!a-c]*", "[a-]x", "[-a]x", "*.[.]", "[[]x", "a+(b)|$^{}\\", "[^a]x", "[]", "[]]", "**", "?", "é[é-ü]"]
    names = ["", "a", "b", "ab", "]b", "x", "zx", "[!]q", "[a", "a]", "a1", "d", "-x", "ax", "q..", "[x", "a+(b)|$^{}\\", "^x", "[]", "]", "éé", "éü", "z", "a\nb"]
    rows = [(t, n) for t, n in itertools.product(tokens, names)]
    got = spark.createDataFrame(rows, "t string, n string").select("t", "n", F.rlike(F.col("n"), glob_pattern(F.col("t"))).alias("hit")).collect()
    wrong = [(r.t, r.n) for r in got if r.hit != fnmatch.fnmatchcase(r.n, r.t)]
    assert not wrong


def test_a_repeated_upsert_key_fails_even_where_no_value_is_read(spark):
    from lakeshift.operators.ledger import merge_upsert

    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        merge_upsert(target, spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string"), ["k"]).count()


def test_the_largest_number_on_the_sheet_limits_partitions_before_the_shuffle(spark):
    from lakeshift.operators.partitions import apply_control_filters

    parts = spark.createDataFrame([(t, f"dt={i:03d}") for t in "ab" for i in range(50)], "t string, partition string")
    sheet = spark.createDataFrame([("a", "last_n_partitions=2"), ("b", "last_n_partitions=3, dt=001")], "t string, partition_filter string")
    out = apply_control_filters(parts, sheet, ["t"])
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [("a", "dt=048"), ("a", "dt=049"), ("b", "dt=001"), ("b", "dt=047"), ("b", "dt=048"), ("b", "dt=049")]
    assert apply_control_filters(parts, sheet.where("t = 'z'"), ["t"]).count() == 0


def test_lists_in_segments(spark, monkeypatch):
    rows = [("hot", f"v{i % 700:04d}") for i in range(2000)] + [("one", "x"), (None, "y"), (None, None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(6)
    got = {(r["k"], r["segment"]): r["values"] for r in windows.segments(df, ["k"], "v", size=50).collect()}
    assert max(map(len, got.values())) == 50 and {k for k, _ in got} == {"hot", "one", None}
    assert [x for _, v in sorted((s, v) for (k, s), v in got.items() if k == "hot") for x in v] == [f"v{i:04d}" for i in range(700)]
    ordered = spark.createDataFrame([("a", f"t{i * 7 % 31}", i) for i in range(31)], "k string, v string, o int")
    parts = windows.segments(ordered, ["k"], "v", "o", size=4)
    assert windows.whole_lists(parts, ["k"], "all").first()["all"] == [f"t{i * 7 % 31}" for i in range(31)]
    assert windows.segments(df.limit(0), ["k"], "v").collect() == []

