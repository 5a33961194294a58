"""Queries for corpus scans and rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from lakeshift.functions.cells import clip
from lakeshift.operators import rewrite as rw
from lakeshift.operators import scan as ops
from lakeshift.rules import migration
from lakeshift.rules import rewrite as R
from lakeshift.rules.model import CORPUS_EXCLUDES, CORPUS_EXTENSIONS, Rule, filter_rules, rules_from_rows
from lakeshift.sources import corpus as source
from lakeshift.sources.metadata import put_texts
from lakeshift.sources.scratch import scratch_dir
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

# text corpus: every document, page and conversation turn is a file
DOC_PATH = "lang || '/' || source || '/doc_' || doc_id || CASE lang WHEN 'en' THEN '.py' WHEN 'fr' THEN '.sql' WHEN 'es' THEN '.conf' ELSE CASE WHEN doc_id % 16 = 0 THEN '.md' ELSE '.properties' END END"
PAGE_PATH = "'pages/' || page_id || '.xml'"
TURN_PATH = "'talks/' || conv_id || '/' || turn || '.yaml'"
TEXTS = f"""SELECT {DOC_PATH} AS path, text AS content FROM documents UNION ALL SELECT {PAGE_PATH}, html FROM pages
    UNION ALL SELECT {TURN_PATH}, text FROM conversations"""


def texts(spark, d):
    docs = B.table(spark, d, "documents").selectExpr(f"{DOC_PATH} AS path", "text AS content")
    pages = B.table(spark, d, "pages").selectExpr(f"{PAGE_PATH} AS path", "html AS content")
    turns = B.table(spark, d, "conversations").selectExpr(f"{TURN_PATH} AS path", "text AS content")
    return docs.unionByName(pages).unionByName(turns)


SECURITY, PERFORMANCE, CONFIG = "Security & Auth", "Performance Considerations", "Configuration Changes"
TEXT_RULES = [
    Rule("TXT-001", "low", CONFIG, "license line", "license", "i"),
    Rule("TXT-002", "high", SECURITY, "mail address", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][a-z]+"),
    Rule("TXT-003", "medium", SECURITY, "phone-like number", r"[0-9]{3}[-. ][0-9]{3,4}"),
    Rule("TXT-004", "critical", SECURITY, "secret", r"(token|secret|password|api_key)[ ]*[=:]", "i"),
    Rule("TXT-005", "info", PERFORMANCE, "script in a page", "<script", "", (".xml",)),
]
WHOLE_RULES = [
    Rule("TXT-010", "medium", CONFIG, "paragraph after a break", r"[.]\n[A-Z][a-z]+ [a-z]+", whole_text=True),
    Rule("TXT-011", "info", PERFORMANCE, "page head", r"<head>.*?</head>", "", (".xml",), whole_text=True),
    Rule("TXT-012", "high", SECURITY, "address over lines", r"@[a-z]+[.][a-z]+\s+[A-Za-z]+", whole_text=True),
]


def lit(value: str) -> str:
    return B.duck_text(value)


def ext_sql(extensions: Sequence[str]) -> str:
    return "(" + " OR ".join(f"ends_with(path, '{e}')" for e in extensions) + ")"


ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
LINE = lit(rf"[^{ENDS}]*(?:\r\n|[{ENDS}])|[^{ENDS}]+")
STRIPPED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def lines_sql(files: str) -> str:
    return f"""SELECT path, unnest(regexp_extract_all(content, {LINE})) AS line,
    CAST(generate_subscripts(regexp_extract_all(content, {LINE}), 1) AS INT) AS line_number FROM ({files})"""


def line_hits(files: str, rules: Sequence[Rule]) -> str:
    return f"WITH lines AS ({lines_sql(files)}) " + " UNION ALL ".join(
        f"SELECT path, line_number, '{r.rule_id}' AS rule_id, {STRIPPED.format('line')} AS line_text FROM lines "
        f"WHERE {ext_sql(r.extensions)} AND regexp_matches(line, {lit(r.pattern)}, '{'i' if 'i' in r.flags else 'c'}')"
        for r in rules
    )


def newlines(x: str) -> str:
    return f"(length({x}) - length(replace({x}, chr(10), '')))"


def text_hits(files: str, rules: Sequence[Rule]) -> str:
    """Matches with the line they start on, from the matches of a pattern and the gaps between them."""
    parts = []
    for r in rules:
        p = lit("(?s)" + r.pattern)
        parts.append(
            f"""SELECT path, rule_id, line_number, replace(arg_min(m, k), chr(10), ' ') AS line_text FROM (
            SELECT path, '{r.rule_id}' AS rule_id, m, k, CAST(1 + list_sum(list_transform(gaps[1:k], lambda x: {newlines("x")}))
            + coalesce(list_sum(list_transform(found[1:k-1], lambda x: {newlines("x")})), 0) AS INT) AS line_number FROM (
            SELECT path, gaps, found, unnest(found) AS m, generate_subscripts(found, 1) AS k FROM (
            SELECT path, regexp_split_to_array(content, {p}) AS gaps, regexp_extract_all(content, {p}) AS found FROM files
            WHERE {ext_sql(r.extensions)}))) GROUP BY ALL"""
        )
    return f"WITH files AS ({files}) " + " UNION ALL ".join(parts)


def facts(hits: str, rules: Sequence[Rule]) -> str:
    rows = ", ".join(f"({lit(r.rule_id)}, {lit(r.title)}, {lit(r.severity)}, {lit(r.category)})" for r in rules)
    return f"SELECT path, rule_id, title, severity, category, line_number, line_text FROM ({hits}) JOIN (VALUES {rows}) v(rule_id, title, severity, category) USING (rule_id)"


LINE_HITS, TEXT_HITS = line_hits(TEXTS, TEXT_RULES), text_hits(TEXTS, WHOLE_RULES)
ISSUES = facts(f"SELECT * FROM ({LINE_HITS}) UNION ALL SELECT path, line_number, rule_id, line_text FROM ({TEXT_HITS})", [*TEXT_RULES, *WHOLE_RULES])


def issues(spark, d):
    return ops.scan(texts(spark, d), [*TEXT_RULES, *WHOLE_RULES])


# some sources lie in places a scan leaves out
PLACED = f"""SELECT CASE source WHEN 'src3' THEN 'build/' WHEN 'src4' THEN 'x/.git/' WHEN 'src5' THEN 'builder/' ELSE '' END || {DOC_PATH}
    || CASE WHEN source = 'src6' THEN 'c' ELSE '' END AS path, n_chars FROM documents"""


@query(
    "corpus_filter",
    f"""SELECT path, n_chars FROM ({PLACED}) WHERE {ext_sql(CORPUS_EXTENSIONS)}
    AND len(list_filter(string_split(path, '/'), lambda x: x IN ({", ".join(lit(e) for e in CORPUS_EXCLUDES if not e.startswith("*"))}) OR ends_with(x, '.pyc'))) = 0""",
)
def corpus_filter(spark, d):
    body, _ = PLACED.rsplit(" FROM ", 1)
    path = body.removeprefix("SELECT ").removesuffix(", n_chars")
    return source.select_corpus(B.table(spark, d, "documents").selectExpr(path, "n_chars"))


@query("scan_lines", LINE_HITS)
def scan_lines(spark, d):
    return ops.scan_lines(texts(spark, d), TEXT_RULES)


@query("scan_multiline", TEXT_HITS)
def scan_multiline(spark, d):
    return ops.scan_whole_text(texts(spark, d), WHOLE_RULES)


@query("scan_issues", ISSUES)
def scan_issues(spark, d):
    return issues(spark, d)


SEVERE = filter_rules([*TEXT_RULES, *WHOLE_RULES], "high")


@query("rule_filter", f"SELECT rule_id, severity, count(*) AS issue_count FROM ({ISSUES}) WHERE severity IN ('critical', 'high') GROUP BY ALL")
def rule_filter(spark, d):
    return ops.scan(texts(spark, d), SEVERE).groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("issue_count"))


@query(
    "issue_summary",
    f"""WITH i AS ({ISSUES}), f AS ({TEXTS}) SELECT 'files_scanned' AS measure, '' AS label, count(*) AS value FROM f
    UNION ALL SELECT 'lines_scanned', '', sum(len(regexp_extract_all(content, {LINE})))::BIGINT FROM f
    UNION ALL SELECT 'total_issues', '', count(*) FROM i UNION ALL SELECT 'by_severity', severity, count(*) FROM i GROUP BY ALL
    UNION ALL SELECT 'by_category', category, count(*) FROM i GROUP BY ALL""",
)
def issue_summary(spark, d):
    return ops.issue_summary(issues(spark, d), texts(spark, d))


RANK = {
    "severity": "list_position(['critical', 'high', 'medium', 'low', 'info'], {0}) - 1",
    "category": "CASE {0} WHEN 'Configuration Changes' THEN 2 WHEN 'Performance Considerations' THEN 5 ELSE 6 END",
    "file": "0",
    "rule": "0",
}


def _group(by: str):
    column = ops.GROUP_COLUMN[by]
    sql = (
        f"SELECT {column} AS group_label, count(*) AS issue_count, count(DISTINCT path) AS file_count, count(DISTINCT rule_id) AS rule_count, "
        f"CAST({RANK[by].format(column)} AS INT) AS group_rank FROM ({ISSUES}) GROUP BY {column}"
    )
    query(f"group_issues_{by}", sql)(lambda spark, d: ops.group_issues(issues(spark, d), by))


for _by in ops.GROUP_COLUMN:
    _group(_by)


@query(
    "ordered_issues",
    f"SELECT *, category AS group_label FROM ({ISSUES}) ORDER BY {RANK['category'].format('category')}, category, path, line_number, rule_id",
)
def ordered_issues(spark, d):
    return ops.ordered_issues(issues(spark, d), "category")


@query(
    "issues_json",
    f"""SELECT category AS group_label, CAST(to_json({{'rule_id': rule_id, 'title': title, 'severity': severity, 'category': category, 'path': path,
    'line_number': line_number, 'line_text': line_text}}) AS VARCHAR) AS issue FROM ({facts(LINE_HITS, TEXT_RULES)})""",
)
def issues_json(spark, d):
    return ops.issues_json(ops.scan(texts(spark, d), TEXT_RULES))


@query(
    "dedupe_issues",
    f"""WITH lines AS ({lines_sql(TEXTS)}), m AS (SELECT path, line_number, unnest(regexp_extract_all(line, '[A-Z][a-z]+')) AS word,
    generate_subscripts(regexp_extract_all(line, '[A-Z][a-z]+'), 1) AS k FROM lines)
    SELECT path, 'CAP' AS rule_id, line_number, arg_min(word, k) AS line_text, CAST(min(k) - 1 AS INT) AS pos FROM m GROUP BY path, line_number""",
)
def dedupe_issues(spark, d):
    """Every capitalised word is an issue; per file, rule and line the first stays."""
    lines = texts(spark, d).select("path", F.posexplode(ops.split_lines("content")).alias("n", "line"))
    words = lines.select(
        "path",
        F.lit("CAP").alias("rule_id"),
        (F.col("n") + 1).alias("line_number"),
        F.posexplode(F.regexp_extract_all("line", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("pos", "line_text"),
    )
    return ops.dedupe_issues(words, "pos")


# code corpus: one file per order, one line per line item, its text picked by the part
CODE = [
    "df.unionAll(other).registerTempTable('t')", "val ctx = new SQLContext(sc)", "SET hive.exec.dynamic.partition = true;",
    "SET mapreduce.job.reduces=4;", "print 'done'", "x = a / b", "for k, v in d.iteritems():", "import urllib2",
    "spark.sql.shuffle.partitions = 200", "spark.dynamicAllocation.enabled=true", "df.write.mode('append').save('out/path')",
    "ADD JAR hdfs://nn/lib/udf.jar;", "dfs -ls /tmp;", "new Integer(5)", "import sun.misc.BASE64Encoder", "thread.stop()",
    "-XX:+UseConcMarkSweepGC", "SELECT CAST(a AS INT) FROM t", "SELECT a FROM t CROSS JOIN u", "rows = df.collect()",
    "# plain comment", "", "    value = compute(1)", "aws_access_key_id = 'ABCDEFGHIJKLMNOPQRST'", "df.repartition(1).write.parquet('x')",
    "sc.accumulator(0)", "raise ValueError, 'bad'", "except IOError, e:", "to_date(col('d'))", "Window.partitionBy('a')",
    "scalaVersion := \"2.11.12\"", "hadoop-client 2.7.3", "pyarrow==0.15", "def f(a, b):", "return a", "w = u'text'",
]
CODE_EXTENSIONS = [".py", ".sql", ".scala", ".conf", ".hql", ".java"]
SCRIPT_EXTENSIONS = [".sql", ".hql", ".conf", ".scala", ".properties", ".java", ".xml", ".sbt", ".yaml"]


def _corpus_sql(lines: Sequence[str], index: str, extensions: Sequence[str], folder: str) -> str:
    return (
        f"SELECT '{folder}/order_' || l_orderkey || {B.pick_sql(extensions, f'l_orderkey % {len(extensions)}')} AS path, "
        f"string_agg({B.pick_sql(lines, index)}, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS content FROM lineitem GROUP BY l_orderkey"
    )


def _corpus(spark, d, lines: Sequence[str], index: str, extensions: Sequence[str], folder: str):
    rows = B.table(spark, d, "lineitem").select(
        "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", B.pick(lines, index).alias("line")).alias("x")
    )
    files = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return files.select(
        F.concat(F.lit(f"{folder}/order_"), F.col("l_orderkey").cast("string"), B.pick(extensions, f"l_orderkey % {len(extensions)}")).alias("path"),
        F.array_join(F.transform("xs", lambda x: x["line"]), "\n").alias("content"),
    )


CODE_INDEX = f"(l_partkey + l_suppkey) % {len(CODE)}"


def code(spark, d, extensions=CODE_EXTENSIONS):
    return _corpus(spark, d, CODE, CODE_INDEX, extensions, "src")


@query("scan_code")
def scan_code(spark, d):
    """All 215 rules over the code corpus, both passes, with the syntax check for Python files."""
    return ops.scan(code(spark, d), migration.ALL_RULES)


SCRIPT_RULES = [
    r
    for r in migration.ALL_RULES
    if not r.whole_text and "(?!" not in r.pattern and "(?<" not in r.pattern
]


@query("scan_scripts", line_hits(_corpus_sql(CODE, CODE_INDEX, SCRIPT_EXTENSIONS, "src"), SCRIPT_RULES))
def scan_scripts(spark, d):
    """All line rules without look-around over files of every kind but Python, where SQL can say the same."""
    return ops.scan_lines(code(spark, d, SCRIPT_EXTENSIONS), SCRIPT_RULES)


# DAG corpus
DAGS = [
    "from airflow import DAG", "from airflow.decorators import dag, task", "  from airflow.operators.python import  PythonOperator, BranchPythonOperator ",
    "from airflow.operators.dummy import DummyOperator", "from airflow.utils.dates import days_ago", "from airflow.utils.dates import cron_presets",
    "from airflow.datasets import Dataset", "from airflow.sensors.time_sensor import TimeSensor", "from airflow.models import Variable, Connection",
    "from airflow.providers.apache.spark.operators.spark_submit import SparkSubmitOperator", "from airflow.utils.session import provide_session",
    "with DAG('d', schedule_interval='@daily', fail_stop=True) as dag:", "    start = DummyOperator(task_id='a', trigger_rule=TriggerRule.DUMMY)",
    "    t = PostgresOperator(task_id='b', postgres_conn_id='pg')", "    when = context['execution_date']", "    x = context.get('prev_ds')",
    "    y = kwargs[ \"next_ds\" ]", "def job(spark, sc):", "def job( spark , sc, n=1):", "    start_date=days_ago( 2 ), end=days_ago(2)",
    "    d = Dataset('s3://x')", "    p = PythonOperator(task_id='c', use_dill=True)", "    q = PythonOperator(use_dill=flag, delegate_to='me')  ",
    "    sla=timedelta(hours=1), sla_miss_callback=f", "    use_task_execution_date = True", "    hook = sensor.get_hook()", "    hook = sensor.get_hook( )",
    "    s = Session()", "    runs = DagRun.find(dag_id='x')", "    a = DatasetAlias('n') | DatasetAll(b)", "    # from airflow import DAG", "", "   ",
    "    bigquery_conn_id='bq', s3_conn_id = 's3'", "    execution_date = context", "    print('plain line')", "import os",
    "    rule = TriggerRule.NONE_FAILED_OR_SKIPPED", "    timetable=t, task_concurrency =3",
]
DAG_INDEX = f"(l_partkey + l_suppkey) % {len(DAGS)}"


def dags(spark, d):
    return _corpus(spark, d, DAGS, DAG_INDEX, [".py"], "dags")


def _import_sql() -> list[tuple[str, str, str, str]]:
    """(condition, new line, category, severity) per import rule; a rule holds when no earlier one does."""
    out, earlier = [], []
    for r in R.IMPORT_RULES:
        pattern = lit(rw.import_pattern(r))
        if r.target.startswith("#"):
            new = lit(r.target)
        elif r.new_name is not None:
            new = lit(f"from {r.target} import {r.new_name}")
        else:
            new = f"{lit(f'from {r.target} import ')} || {STRIPPED.format(f'regexp_extract(s, {pattern}, 1)')}"
        barred = "".join(f" AND NOT regexp_matches(s, {e})" for e in earlier)
        out.append((f"regexp_matches(s, {pattern}){barred}", new, r.category, r.severity))
        earlier.append(pattern)
    return out


def _check_sql() -> list[tuple[str, str, str, bool]]:
    """(condition, new line, category, fixable) of all other checks, in report order."""
    def m(p: str) -> str:
        return f"regexp_matches(s, {lit(p)})"

    def sub(p: str, new: str) -> str:
        return f"regexp_replace(s, {lit(p)}, {lit(new)}, 'g')"

    plain = "NOT (starts_with(s, 'from ') OR starts_with(s, 'import '))"
    out = []
    for old, new in R.DAG_PARAMETERS.items():
        p = rf"\b{old}\s*="
        out.append((m(p), f"replace(s, rtrim(regexp_extract(s, {lit(p)}), '= '), {lit(new)})", "DAG Parameters", True))
    for old, new in R.CONTEXT_KEYS.items():
        p = rf"""context\s*\[\s*['"]{old}['"]|context\.get\s*\(\s*['"]{old}['"]\s*|\bkwargs\s*\[\s*['"]{old}['"]|\b{old}\s*=\s*context"""
        fixed = f"replace(s, '{old}', '{new}')" if new else lit(f"# MANUAL FIX REQUIRED: {old} removed; compute manually")
        out.append((m(p), fixed, "Context Variables", new is not None))
    for old, new in R.TRIGGER_RULES.items():
        out.append((f"contains(s, 'TriggerRule.{old}')", f"replace(s, 'TriggerRule.{old}', 'TriggerRule.{new}')", "Trigger Rules", True))
    for old, new in R.OPERATOR_CLASSES.items():
        out.append((m(rf"\b{old}\s*\("), sub(rf"\b{old}\b", new), "Operator Rename", True))
    for old, new in R.CONNECTION_PARAMETERS.items():
        out.append((m(rf"\b{old}\s*="), sub(rf"\b{old}\b", new), "Connection Parameters", True))
    out.append((m(r"^def\s+\w+\s*\(\s*spark\s*,\s*sc\s*"), sub(r"\(\s*spark\s*,\s*sc\s*", "(spark"), "PySpark Decorator", True))
    days = lit(r"\bdays_ago\s*\(\s*(\d+)\s*\)")
    today = f"'pendulum.today(''UTC'').add(days=-' || regexp_extract(s, {days}, 1) || ')'"
    out.append((f"regexp_matches(s, {days})", f"replace(s, regexp_extract(s, {days}), {today})", "Removed Utility", True))
    out.append((f"{plain} AND {m(r'\bDataset\s*\(')}", sub(r"\bDataset\b", "Asset"), "Assets Rename", True))
    out.append((m(r"\buse_dill\s*="), sub(r",?\s*use_dill\s*=\s*(True|False)", ""), "Removed Parameters", True))
    out.append((m(r"\bsla\s*=\s*timedelta"), lit(R.SLA_MARK), "Removed Feature", False))
    out.append((m(r"\bsla_miss_callback\s*="), lit(R.SLA_CALLBACK_MARK), "Removed Feature", False))
    out.append((m(r"\buse_task_execution_date\s*="), sub(r"\buse_task_execution_date\b", "use_task_logical_date"), "Removed Parameters", True))
    out.append((m(r"\bdelegate_to\s*="), sub(r"\bdelegate_to\b", "impersonation_chain"), "Google Provider", True))
    out.append((m(r"\.get_hook\s*\(\s*\)"), "replace(s, '.get_hook()', '.hook')", "AWS Provider", True))
    earlier = ""
    for p, text in R.DB_ACCESS:
        out.append((f"{plain}{earlier} AND {m(p)}", lit(f"# MANUAL FIX REQUIRED: {text}; use REST API"), "Database Access", False))
        earlier += f" AND NOT {m(p)}"
    for old, new in R.ASSET_CLASSES.items():
        out.append((plain + " AND " + m(rf"\b{old}\s*\("), sub(rf"\b{old}\b", new), "Assets Rename", True))
    return out


DAG_FILES = _corpus_sql(DAGS, DAG_INDEX, [".py"], "dags")
DAG_LINES = f"""lines AS ({lines_sql(DAG_FILES)}), stripped AS (SELECT *, {STRIPPED.format("line")} AS s FROM lines),
code AS (SELECT * FROM stripped WHERE s <> '' AND NOT starts_with(s, '#'))"""
FIRST_IMPORT = " UNION ALL ".join(
    f"SELECT path, line_number, 0 AS ord, '{c}' AS category, '{v}' AS severity, s AS old_code, {n} AS new_code, TRUE AS auto_fixable FROM code WHERE {w}"
    for w, n, c, v in _import_sql()
)
FOUND = f"""{DAG_LINES}, imports AS ({FIRST_IMPORT}), found AS (SELECT * FROM imports WHERE new_code <> old_code UNION ALL """ + " UNION ALL ".join(
    f"SELECT path, line_number, {i + 1}, '{c}', 'BREAKING', s, {n}, {str(f).upper()} FROM code WHERE {w}" for i, (w, n, c, f) in enumerate(_check_sql())
) + ")"
FINDINGS = f"""WITH {FOUND} SELECT path, line_number, CAST(row_number() OVER (PARTITION BY path, line_number ORDER BY ord) - 1 AS INT) AS finding_number,
    category, severity, old_code, new_code, auto_fixable FROM found"""


@query("first_rule_per_line", f"WITH {DAG_LINES} SELECT path, line_number, old_code, new_code, category, severity FROM ({FIRST_IMPORT})")
def first_rule_per_line(spark, d):
    return rw.first_rule_per_line(dags(spark, d))


@query("rewrite_findings", FINDINGS)
def rewrite_findings(spark, d):
    return rw.rewrite_findings(dags(spark, d)).drop("description")


@query(
    "apply_rewrites",
    f"""WITH {FOUND}, fixed AS (SELECT path, line_number, arg_min(new_code, ord) FILTER (WHERE {STRIPPED.format("new_code")} <> old_code) AS new_code,
    count(*) AS n FROM found WHERE auto_fixable GROUP BY ALL),
    done AS (SELECT path, line_number, n, CASE WHEN n IS NULL THEN regexp_replace(line, '(?:\\r\\n|[{ENDS}])$', '')
    ELSE regexp_extract(line, '^(\\s*)', 1) || coalesce(new_code, s) END AS line FROM stripped LEFT JOIN fixed USING (path, line_number))
    SELECT f.path, CAST(count(n) AS INT) AS changed_lines, coalesce(string_agg(line, chr(10) ORDER BY line_number), '') || chr(10) AS content
    FROM ({DAG_FILES}) f LEFT JOIN done USING (path) GROUP BY f.path""",
)
def apply_rewrites(spark, d):
    return rw.apply_rewrites(dags(spark, d))


@query(
    "finding_summary",
    f"""WITH f AS ({FINDINGS}) SELECT 'total' AS measure, '' AS label, count(*) AS value FROM f UNION ALL SELECT 'by_severity', severity, count(*) FROM f GROUP BY ALL
    UNION ALL SELECT 'by_category', category, count(*) FROM f GROUP BY ALL UNION ALL SELECT 'by_file', path, count(*) FROM f GROUP BY ALL
    UNION ALL SELECT 'auto_fixable', '', count(*) FILTER (WHERE auto_fixable) FROM f UNION ALL SELECT 'files_with_issues', '', count(DISTINCT path) FROM f""",
)
def finding_summary(spark, d):
    return rw.finding_summary(rw.rewrite_findings(dags(spark, d)))


# rules as a user's own table holds them, one per lang and word of the corpus
USER_RULES = [
    {"rule_id": "OWN-1", "severity": "high", "category": CONFIG, "title": "stop", "pattern": r"thread[.]stop", "extensions": [".py", ".scala"]},
    {"rule_id": "OWN-2", "severity": "info", "category": PERFORMANCE, "title": "join", "pattern": "cross join", "flags": "i"},
]


@query("user_rules", facts(line_hits(_corpus_sql(CODE, CODE_INDEX, CODE_EXTENSIONS, "src"), rules_from_rows(USER_RULES)), rules_from_rows(USER_RULES)))
def user_rules(spark, d):
    return ops.scan(code(spark, d), rules_from_rows(USER_RULES))


# DAG files on storage: one per supplier, some in places or with names that a scan leaves out
DAG_FILE = """CASE s_suppkey % 7 WHEN 1 THEN '.git/' WHEN 2 THEN 'a/__pycache__/' WHEN 3 THEN 'deep/er/' ELSE '' END || 'dag_' || s_suppkey
    || CASE s_suppkey % 5 WHEN 1 THEN '.py.bak' WHEN 2 THEN '.sql' ELSE '.py' END"""
DAG_TEXT = "'# ' || s_name || chr(13) || chr(10) || 'x = ' || s_suppkey || chr(10)"


@query(
    "dag_corpus",
    f"""SELECT path, replace(content, chr(13) || chr(10), chr(10)) AS content FROM (SELECT {DAG_FILE} AS path, {DAG_TEXT} AS content FROM supplier)
    WHERE ends_with(path, '.py') AND NOT starts_with(path, '.git/') AND NOT contains(path, '__pycache__')""",
)
def dag_corpus(spark, d):
    """Files written from the suppliers and read back as a corpus of DAGs."""
    root = scratch_dir(spark, "dags")
    files = B.table(spark, d, "supplier").selectExpr(f"{DAG_FILE} AS path", f"{DAG_TEXT} AS content")
    put_texts(files, root)
    return source.read_dag_corpus(spark, root)


@query("clip_text", "SELECT doc_id, substr(text, 1, 500) AS short, substr(text, 1, 2000) AS long FROM documents")
def clip_text(spark, d):
    """Messages cut to the lengths that the ledgers' columns hold."""
    return B.table(spark, d, "documents").select("doc_id", clip("text", 500).alias("short"), clip("text", 2000).alias("long"))
