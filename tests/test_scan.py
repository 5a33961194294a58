import ast
import random

import pytest
from pyspark.sql import functions as F

from lakeshift.functions.text import required_literals
from lakeshift.operators import scan as ops
from lakeshift.rules import migration
from lakeshift.rules.model import CORPUS_EXTENSIONS, SEVERITIES, Rule, filter_rules, rules_from_rows
from lakeshift.sources import corpus as source
from lakeshift.workload.corpora import CODE

FILES = {
    "a.py": "from pyspark import SparkContext\nsqlContext = SQLContext(sc)\n# SQLContext in a comment\nx = '''\nSQLContext\n'''\nprint 'x'\n",
    "ok.py": "import os\n\n# sqlContext = 1\nsqlContext = 2\ndf.unionAll(\n  other)\nd.unionAll (x).unionAll(y)\n",
    "q.hql": "SET hive.exec.parallel = true;\nset mapred.reduce.tasks=3;\n  dfs -ls /x;\nADD JAR x.jar;\n",
    "q.sql": "create table t (a int)\nstored as orc;\nSELECT a FROM t GROUP BY a\n  dfs -ls\n",
    "b.sbt": "scalaVersion := \"2.11.8\"\n",
    "c.conf": "spark.sql.shuffle.partitions=200\r\nspark.speculation = true\rfs.s3a.access.key=ABCDEFGHIJKLMNOPQRST",
    "d.java": "new Integer(5);\nimport sun.misc.BASE64Encoder;\nprotected void finalize() {}\n@Override\npublic void\nfinalize() {}\n",
    "e.py": "def f(a, (b, c)):\n    print >>x, 1\n    raise E, 'x'\nu'é' + 0777 + 12L\nclass A:\n\tpass\n",
    "f.scala": "Window.partitionBy(\"a\")\nWindow.orderBy(\"b\").rowsBetween(1, 2)\nto_date(col)\n",
    "g.py": "\x0c\nx = a / b\x85y <> z long(3)\n",
    "empty.py": "",
    "ſpark.conf": "SPARK.KUBERNETES.\nspark.kubernetes.x=1\nſet hive.exec.x=1\n",
    "long.sql": "ſet hive.exec.x=1\nSET HİVE.exec.y=2\nSET hive.exec.z=3\n",
    "mix.py": "\n".join(CODE),
}


def expected(files, rules):
    """The two passes, one file, rule and line at a time."""
    found = set()
    for path, raw in files.items():
        content = raw.replace("\r\n", "\n").replace("\r", "\n")
        runs = None
        if path.endswith(".py"):
            try:
                runs = {n for node in ast.walk(ast.parse(content)) if hasattr(node, "lineno") for n in range(node.lineno, (node.end_lineno or node.lineno) + 1)}
            except SyntaxError:
                runs = None
        for r in rules:
            if not path.endswith(r.extensions):
                continue
            if not r.whole_text:
                for n, line in enumerate(content.splitlines(keepends=True), 1):
                    if r.python_pattern.search(line) and not (r.ast_aware and runs is not None and n not in runs):
                        found.add((path, r.rule_id, n, line.strip()[:200]))
                continue
            seen = set()
            for m in r.python_pattern.finditer(content):
                n = content.count("\n", 0, m.start()) + 1
                if n not in seen:
                    seen.add(n)
                    found.add((path, r.rule_id, n, m.group(0).replace("\n", " ")[:200]))
    return found


@pytest.fixture(scope="module")
def corpus(spark):
    df = spark.createDataFrame(list(FILES.items()), "path string, raw string")
    return df.select("path", source.universal_newlines(df.raw).alias("content"))


def test_all_rules_equal_a_plain_scan(corpus):
    got = {(r.path, r.rule_id, r.line_number, r.line_text) for r in ops.scan(corpus, migration.ALL_RULES).collect()}
    want = expected(FILES, migration.ALL_RULES)
    assert got == want and len(want) > 60


def test_code_corpus_equals_a_plain_scan(spark, small):
    from lakeshift.workload import corpora

    files = {r.path: r.content for r in corpora.code(spark, small).collect()}
    got = {(r.path, r.rule_id, r.line_number, r.line_text) for r in corpora.scan_code(spark, small).collect()}
    assert got == expected(files, migration.ALL_RULES)


def test_packs():
    assert {k: len(v) for k, v in migration.PACKS.items()} == {
        "spark_api": 22, "spark_sql": 54, "config": 10, "dependencies": 10, "hdfs_to_s3": 20, "performance": 5, "jdk": 44, "python": 50,
    }
    assert len({r.rule_id for r in migration.ALL_RULES}) == 215
    assert sum(r.whole_text for r in migration.ALL_RULES) == 25 and sum(r.ast_aware for r in migration.ALL_RULES) == 70
    assert all(r.severity in SEVERITIES for r in migration.ALL_RULES)


def test_patterns_mean_the_same_in_java(spark):
    from pyspark.sql import functions as F

    lines = [line + "\n" for line in CODE]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    rules = [r for r in migration.ALL_RULES if not r.whole_text]
    row = df.select(*[F.col("line").rlike(r.java_pattern).alias(r.rule_id) for r in rules], "line").collect()
    for found in row:
        for r in rules:
            assert found[r.rule_id] == bool(r.python_pattern.search(found["line"])), (r.rule_id, found["line"])


def test_required_literals():
    assert required_literals(r"\bfoo\s*\(bar|ba[zx]+qux") == ["(bar", "qux"]
    assert required_literals(r"a?b*[cd]") == []
    assert required_literals(r"(?:abc)+x") == ["abc"]


def test_big_texts_take_part_unless_a_limit_is_given(spark):
    rule = Rule("X", "low", "Configuration Changes", "t", "a.b", whole_text=True)
    df = spark.createDataFrame([("x.sql", "a\nb" + " " * (1024 * 1024)), ("y.sql", "a\nb")], "path string, content string")
    assert sorted(r.path for r in ops.scan_whole_text(df, [rule]).collect()) == ["x.sql", "y.sql"]
    assert [r.path for r in ops.scan_whole_text(df, [rule], max_bytes=1024 * 1024).collect()] == ["y.sql"]


def test_inline_flags_lose_no_hits(spark):
    rules = [Rule(f"X{i}", "low", "Configuration Changes", "t", p) for i, p in enumerate(["(?i)license", "a (?i:license)", "license"])]
    df = spark.createDataFrame([("x.sql", "a LICENSE\na license" + " " * 500 + "end")], "path string, content string")
    hits = ops.scan_lines(df, rules).collect()
    assert sorted((r.rule_id, r.line_number) for r in hits) == [("X0", 1), ("X0", 2), ("X1", 1), ("X1", 2), ("X2", 2)]
    assert any(r.line_text.endswith("end") for r in hits)


def test_rule_selection():
    rules = filter_rules(migration.ALL_RULES, "high", ["Python 2 to 3 Migration"])
    assert len(rules) == 35 and {r.severity for r in rules} == {"critical", "high"}
    own = rules_from_rows([{"rule_id": "O", "severity": "low", "category": "Security & Auth", "title": "t", "pattern": "x", "extensions": [".md"]}])
    assert own[0].extensions == (".md",)


def test_summary_and_groups(corpus):
    issues = ops.scan(corpus, migration.ALL_RULES)
    want = expected(FILES, migration.ALL_RULES)
    summary = {(r.measure, r.label): r.value for r in ops.issue_summary(issues, corpus).collect()}
    assert summary["files_scanned", ""] == len(FILES) and summary["total_issues", ""] == len(want)
    lines = sum(len(c.replace("\r\n", "\n").replace("\r", "\n").splitlines()) for c in FILES.values())
    assert summary["lines_scanned", ""] == lines
    by_severity = [r.group_label for r in ops.group_issues(issues, "severity").collect()]
    assert by_severity == [s for s in SEVERITIES if s in by_severity]
    files = [r.group_label for r in ops.group_issues(issues, "file").collect()]
    assert files == sorted(files)


def test_read_corpus(spark, work):
    import os

    for path in ("src/a.py", "src/build/b.py", "src/x.md", "src/.git/c.sql", "deep/er/q b.sql", "m.pyc", "builder/k.conf"):
        os.makedirs(os.path.dirname(f"{work}/{path}"), exist_ok=True)
        with open(f"{work}/{path}", "w", newline="") as f:
            f.write("one\r\ntwo")
    got = {r.path: r.content for r in source.read_corpus(spark, work).collect()}
    assert got == {p: "one\ntwo" for p in ("src/a.py", "deep/er/q b.sql", "builder/k.conf")}
    assert ".hql" in CORPUS_EXTENSIONS


def test_running_totals_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(ops, "BLOCK", 4)
    rows = [(i, [(i * 7 + k) % 5 for k in range(i)]) for i in (0, 1, 3, 4, 5, 8, 9, 100)]
    got = spark.createDataFrame(rows, "i int, xs array<int>").select("i", "xs", ops.running_totals(F.col("xs")).alias("t")).collect()
    assert len(got) == len(rows) and all(r.t == [sum(r.xs[: k + 1]) for k in range(len(r.xs))] for r in got)


def test_match_offsets_equal_those_of_a_regex_engine(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a(", ")", "b", "\n", "x", " ", "\r\n", "é", "CREATE TABLE t", "USING", "udf(lambda", ":"], k=rng.randrange(0, 120))) for _ in range(150)]
    texts += ["", "\n\n", "a(" + "\n" * 5000 + "x)" * 3000]
    patterns = [r"a\([\s\S]*?\)", r"x\s+x|b+", r"CREATE\s+(?:EXTERNAL\s+)?TABLE\s+(?![\s\S]*USING)", r"udf\s*\(\s*lambda[\s\S]+?:[\s\S]+?\)(?!\s*,)", r"^x", r"(a)(b)?"]
    rules = [Rule(f"R{i}", "low", "Configuration Changes", "t", p, "im" if i == 2 else "", whole_text=True) for i, p in enumerate(patterns)]
    want = []
    for n, text in enumerate(texts):
        for r in rules:
            reported = 0
            for m in r.python_pattern.finditer(text):
                line = 1 + text.count("\n", 0, m.start())
                if line != reported:
                    want.append((f"f{n}.sql", line, r.rule_id, m.group(0).replace("\n", " ")))
                reported = line
    df = spark.createDataFrame([(f"f{n}.sql", t) for n, t in enumerate(texts)], "path string, content string")
    found = ops.scan_whole_text(df, rules)
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
    for bad in (r"(a)\1", "x*"):
        with pytest.raises(ValueError):
            ops.scan_whole_text(df, [Rule("B", "low", "Configuration Changes", "t", bad, whole_text=True)])


def test_a_scan_reads_its_corpus_once(spark, work):
    rows = [("a.py", "x = 1\ndf.unionAll(y)\n'''\nprint 'in a text'\n'''\n"), ("b.py", "nothing"), ("c.sql", "SET hive.x = 1;")]
    spark.createDataFrame(rows, "path string, content string").write.parquet(f"{work}/corpus")
    found = ops.scan(spark.read.parquet(f"{work}/corpus"), migration.ALL_RULES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert {("a.py", 2, "SPARK-009")} <= {(r.path, r.line_number, r.rule_id) for r in found.collect()}
