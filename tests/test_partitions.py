from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from lakeshift.functions import partitions as P
from lakeshift.operators import partitions as ops

PARTS = ["dt=2024-01-01", "dt=2024-01-02", "dt=2024-01-03", "year=2023/month=11", "year=2023/month=12", "year=2024/month=01"]


def run(spark, parts, expr):
    df = spark.createDataFrame([(p,) for p in parts], "partition string")
    return sorted(r[0] for r in ops.apply_partition_filter(df, expr).collect())


@pytest.mark.parametrize(
    "parts, expr, want",
    [
        (PARTS, "", PARTS),
        (PARTS, None, PARTS),
        (PARTS, "dt=2024-01-02", ["dt=2024-01-02"]),
        (PARTS, "dt=1999-01-01", []),
        (["city=New%20York", "city=London"], "city=New York", []),
        (["city=New%20York", "city=London"], "city=New%20York", ["city=New%20York"]),
        (["city=New%20York", "city=London"], "city>London", ["city=New%20York"]),
        (PARTS, "year=2023/*", ["year=2023/month=11", "year=2023/month=12"]),
        (["year=20231/m=1", "year=2023/m=1"], "year=2023/*", ["year=20231/m=1", "year=2023/m=1"]),
        (["region=us/a=1", "region=eu/a=1"], "region=us*", ["region=us/a=1"]),
        (PARTS, "*", PARTS),
        (PARTS, "last_n_partitions=2", ["year=2023/month=12", "year=2024/month=01"]),
        (["p=9", "p=10"], "last_n_partitions=1", ["p=9"]),
        (PARTS, "last_n_partitions=100", PARTS),
        (["dt=2024-01-01", "dt=2024-01-03"], "dt>2024-01-01", ["dt=2024-01-03"]),
        (["year=2022/m=6", "year=2023/m=1", "year=2024/m=1"], "year<=2023", ["year=2022/m=6", "year=2023/m=1"]),
        (["id=5", "id=10", "id=15"], "id>=10", ["id=10", "id=15"]),
        (["id=5", "id= 1_0 ", "id=+15"], "id>=10", ["id= 1_0 ", "id=+15"]),
        (["ver=a1", "ver=b2", "ver=c3", "ver=9"], "ver>=b2", ["ver=b2", "ver=c3"]),
        (["dt=2024-01-01"], "month>=01", []),
        (["dt=2024-01-05", "dt=2024-02-01", "dt=2023-12-31"], "dt>=2024-01*", ["dt=2024-01-05", "dt=2024-02-01"]),
        (["dt=a", "dt=b", "dt=c", "dt=d"], "dt=a, last_n_partitions=1", ["dt=a", "dt=d"]),
        (["dt=2024-01-01", "dt=2024-01-09"], "dt>=2024-01-05,dt<=2024-01-02", ["dt=2024-01-01", "dt=2024-01-09"]),
        (["dt=2024-01-01"], "garbage!!term", []),
    ],
)
def test_filter_grammar(spark, parts, expr, want):
    assert run(spark, parts, expr) == sorted(want)
    # the same expression carried by a control row
    table = spark.createDataFrame([("t", p) for p in parts], "table_name string, partition string")
    control = spark.createDataFrame([("t", expr)], "table_name string, partition_filter string")
    got = ops.apply_control_filters(table, control, ["table_name"]).select("partition").collect()
    assert sorted(r[0] for r in got) == sorted(want)


def test_last_n_is_per_table(spark):
    df = spark.createDataFrame([("a", "p=1"), ("a", "p=2"), ("b", "p=1")], "t string, partition string")
    got = ops.apply_partition_filter(df, "last_n_partitions=1", keys=["t"]).collect()
    assert sorted(map(tuple, got)) == [("a", "p=2"), ("b", "p=1")]


def test_values_decode_like_paths(column):
    texts = ["a%20b", "a+b", "100%", "%zz%41", "%C3%A9"]
    got = column(lambda c: P.partition_value(F.concat(F.lit("k="), c), "k"), texts)
    assert got == [unquote(t) for t in texts]


def test_partition_map(column):
    assert column(P.partition_map, ["year=2024/month=01/x", " k = v=w "]) == [{"year": "2024", "month": "01"}, {"k": "v=w"}]


def test_predicate(spark):
    df = spark.createDataFrame([(2024, "01", "O'Brien"), (2024, "02", "x"), (2023, "01", "y")], "year int, month string, city string")
    count = lambda parts: df.where(P.partitions_predicate(parts)).count()
    assert count([]) == 0
    assert count(["no_equals_here"]) == 3
    assert count(["year=2024/month=01"]) == 1
    assert count(["year=2024/month=01", "year=2023/month=01"]) == 2
    assert count(["city=O'Brien"]) == 1
    assert count(["city=O%27Brien"]) == 1


def test_predicate_prunes_directories(spark, work):
    spark.range(100).selectExpr("id", "id % 10 AS k").write.partitionBy("k").parquet(f"{work}/t")
    df = spark.read.parquet(f"{work}/t").where(P.partitions_predicate(["k=3", "k=4"]))
    assert df.count() == 20
    assert len(df.inputFiles()) == 0 or "PartitionFilters: [((" in df._jdf.queryExecution().toString().replace("k#", "((k#")


def test_keep_partitions_joins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    listed = spark.createDataFrame([("k=a",), ("k=c",)], "partition string")
    assert [r.id for r in ops.keep_partitions(df, listed, ["k"]).collect()] == [1]


def test_nonempty_partitions(spark):
    rows = [("t", "p=1", 0), ("t", "p=2", 5), ("t", "p=3", None), ("t", "p=1", 0)]
    df = spark.createDataFrame(rows, "t string, partition string, length long")
    assert tuple(ops.nonempty_partition_counts(df, ["t"]).first()) == ("t", 3, 2)
