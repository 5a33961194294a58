from pyspark.sql import functions as F

from lakeshift.functions import access as A
from lakeshift.functions import cells as C
from lakeshift.functions import measures as M


def test_null_like(column):
    assert column(C.null_like, [None, "", "  ", "NaN", "null", "None", "0", "x"]) == [True] * 6 + [False] * 2


def test_cell_str_strips_all_whitespace(column):
    assert column(lambda c: C.cell_str(c, "d"), [" a ", "\tb\n", "nan", None]) == ["a", "b", "d", "d"]


def test_flags(column):
    assert column(C.parse_flag, ["T", "true", " yes ", "1", "F", "no", "y", None]) == [True] * 4 + [False] * 4
    assert column(C.parse_setting, ["on", "Y", "off", "0", "maybe", None]) == [True, True, False, False, True, True]
    assert column(lambda c: C.parse_setting(c, False), ["maybe", None, "yes"]) == [False, False, True]


def test_normalize_s3(column):
    given = ["s3://b/k", "s3n://b", "s3a://b", "b/k", "", None]
    assert column(C.normalize_s3, given) == ["s3a://b/k", "s3a://b", "s3a://b", "s3a://b/k", "", None]


def test_names_of_paths(column):
    assert column(C.basename, ["/a/b/", "hdfs:///x/y", "z"]) == ["b", "y", "z"]
    assert column(C.bucket_name, ["s3a://My-Bucket/x", "s3n://b", "plain/x"]) == ["my-bucket", "b", "plain"]
    assert column(C.endpoint_slug, ["https://S3.eu-1.x.com:9000/p", "minio.local", "host:9000"]) == [
        "S3_EU_1_X_COM", "MINIO_LOCAL", "HOST:9000",
    ]
    assert column(lambda c: C.slugify(c, 8), ["a b/c-d_e.f"]) == ["a_b_c-d_"]


def test_dest_path(spark):
    rows = [
        ("s3a://src/wh/db/t", "d", "t", "s3a://lake/", "s3a://src/wh", "s3a://dst/new/"),
        ("s3a://other/t", "d", "t", "s3a://lake/", "s3a://src/wh", "s3a://dst"),
        ("s3a://src/wh/t", "d", "t", "s3a://lake", "", "s3a://dst"),
    ]
    df = spark.createDataFrame(rows, "s string, d string, t string, b string, sp string, dp string")
    got = [r[0] for r in df.select(C.dest_path("s", "d", "t", "b", "sp", "dp")).collect()]
    assert got == ["s3a://dst/new/db/t", "s3a://lake/d/t", "s3a://lake/d/t"]


def test_conversion_database(spark):
    df = spark.createDataFrame([("a", None, True), ("a", "nan", False), ("a", " b ", False)], "s string, d string, i boolean")
    assert [r[0] for r in df.select(C.conversion_database("s", "d", "i")).collect()] == ["a", "a_iceberg", "b"]


def test_detect_format(column):
    given = ["x.MapredParquetInputFormat", "x.OrcInputFormat", "x.AvroContainer", "mapred.TextInputFormat", "other"]
    assert column(C.detect_format, given) == ["PARQUET", "ORC", "AVRO", "TEXTFILE", "PARQUET"]


def test_serde_properties(column):
    got = column(C.serde_properties, ["[field.delim=|, serialization.format=1, null.format=NULL]", "[]", None])
    assert got == [{"field.delim": "|", "null.format": "NULL"}, {}, None]


def test_csv_and_permissions(column):
    assert column(C.csv_array, ["a, b,,c ", "nan", None, " "]) == [["a", "b", "c"], [], [], []]
    assert column(A.permission_array, ["Read, WRITE", None, ","]) == [["read", "write"], ["read"], ["read"]]


def test_permission_expansion(column):
    def sizes(c):
        return F.size(A.expand_permissions(A.permission_array(c)))

    assert column(sizes, ["read", "write", "all", "select", "read,write"]) == [5, 16, 17, 1, 16]
    url = lambda c: F.sort_array(A.expand_url_permissions(A.permission_array(c)))
    assert column(url, ["select", "update", "execute", "read,all"]) == [["read"], ["read", "write"], ["execute"], ["read", "write"]]
    kept = lambda c: A.supported_access(A.permission_array(c), ["read", "use"])
    assert column(kept, ["read,drop,use", "drop"]) == [["read", "use"], []]
    assert column(lambda c: A.supported_access(A.permission_array(c), None), ["a,b,a"]) == [["a", "b"]]


def test_policy_names(spark):
    cases = [("db1", "t1", "c1"), ("db1", "t1", "*"), ("db1", "*", "*"), ("*", "*", "*"), ("db1", "*", "amount")]
    df = spark.createDataFrame(cases, "d string, t string, c string")
    names = [tuple(r) for r in df.select(A.policy_name("d", "t", "c"), A.rowfilter_policy_name("d", "t")).collect()]
    assert names == [
        ("iceberg.db1.t1.c1", "iceberg.db1.t1__rowfilter"),
        ("iceberg.db1.t1", "iceberg.db1.t1__rowfilter"),
        ("iceberg.db1", "iceberg.db1__rowfilter"),
        ("iceberg", "iceberg__rowfilter"),
        ("iceberg.db1.*.amount", "iceberg.db1__rowfilter"),
    ]


def test_labels_round_trip(column):
    label = "r 1->g (group)"
    assert column(A.label_principal, [label, "r->u x (user)", "odd"]) == ["g", "u x", ""]
    assert column(A.label_role, [label, "odd"]) == ["r 1", ""]
    assert column(A.label_group, [label, "r->u (user)"]) == ["g", None]


def test_rowfilter_and_item_type(column):
    assert column(A.rowfilter_valid, ["a = 1", "a; drop", "a\nb", None]) == [True, False, False, True]
    assert column(A.item_type, ["Deny", "bogus", None, " allow_exception "]) == ["deny", "allow", "allow", "allow_exception"]


def test_size_rules(spark):
    df = spark.createDataFrame([(1000, 991), (1000, 990), (0, 1), (0, 0), (150, 149)], "a long, b long")
    got = [tuple(r) for r in df.select(M.size_match_rel("a", "b"), M.size_match_abs("a", "b")).collect()]
    assert got == [(True, True), (False, True), (False, True), (True, True), (True, True)]


def test_rates_guard_zero_and_null(spark):
    df = spark.createDataFrame([(2097152, 0.0, None), (None, None, 4.0)], "size long, secs double, total double")
    got = [tuple(r) for r in df.select(M.speed_mib("size", "secs"), M.rows_per_second("size", "total")).collect()]
    assert got == [(2.0, 2097152.0), (0.0, 0.0)]
