"""Queries for the policy compiler, identity plans and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.operators import windows
from lakeshift.operators import lineage, policy, principals, report
from lakeshift.plans import policy_run
from lakeshift.sources.scratch import stored
from lakeshift.workload import base as B
from lakeshift.workload.cells import access_list, csv_list, nullish, permission_list, url_access_list, words
from lakeshift.workload.registry import query

KEYS = ["sheet_id"]
ROLE = ["policy_name", "role", "item_type"]
# a sheet spans several blocks even at the smallest scale
BLOCK_ROWS = 500

W = "OVER (PARTITION BY sheet_id ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _last(x: str, default: str) -> str:
    return f"coalesce(last_value({x} IGNORE NULLS) {W}, {default})"


FILLED = f"""raw AS ({B.SHEET_SQL}),
flags AS (SELECT *, NOT {nullish("database")} AS new_db, NOT {nullish("url")} AND trim(url) NOT IN ('-', '*') AS new_url FROM raw),
filled AS (SELECT * REPLACE (
  {_last("CASE WHEN new_db THEN trim(database) WHEN new_url THEN '' END", "''")} AS database,
  {_last("CASE WHEN new_url THEN trim(url) WHEN new_db THEN '' END", "''")} AS url,
  {_last(f"CASE WHEN NOT {nullish('tables')} THEN trim(tables) WHEN new_db THEN '*' END", "'*'")} AS tables,
  {_last(f'CASE WHEN NOT {nullish(chr(34) + "columns" + chr(34))} THEN trim("columns") WHEN new_db THEN ' + "'*' END", "'*'")} AS "columns",
  last_value(CASE WHEN NOT {nullish("policy_label")} THEN trim(policy_label) END IGNORE NULLS) {W} AS policy_label) FROM flags)"""

CHECKED = f"""{FILLED},
clean AS (SELECT sheet_id, row_index, database, url, tables, "columns", policy_label,
  CASE WHEN {nullish("role")} THEN '' ELSE trim(role) END AS role, {permission_list("permissions")} AS permissions,
  {csv_list('"groups"')} AS "groups", {csv_list('"users"')} AS "users",
  CASE WHEN {nullish("rowfilter")} THEN '' ELSE trim(rowfilter) END AS rowfilter,
  CASE WHEN lower(trim(item_type)) IN ('allow', 'allow_exception', 'deny', 'deny_exception') THEN lower(trim(item_type)) ELSE 'allow' END AS item_type,
  NOT {nullish("database")} AS has_db, NOT {nullish("url")} AND url NOT IN ('-', '*') AS has_url FROM filled),
r1 AS (SELECT *, CASE WHEN has_db = has_url THEN 'row needs either a database or a url'
  WHEN has_url AND rowfilter <> '' THEN 'row filters do not apply to url policies'
  WHEN contains(rowfilter, ';') OR contains(rowfilter, chr(10)) OR contains(rowfilter, chr(13)) THEN 'row filter holds a statement end or a line break' END AS e1 FROM clean),
checked AS (SELECT *, CASE WHEN e1 IS NULL AND rowfilter <> '' AND item_type <> 'allow' THEN 'row filter ignored: only allow items may carry one' END AS e2,
  CASE WHEN e1 IS NULL AND role = '' AND len("groups") > 0 THEN 'groups need a role'
  WHEN e1 IS NULL AND role = '' AND len("users") = 0 THEN 'row defines no role binding' END AS e3 FROM r1)"""

PRINCIPALS = f"""{CHECKED},
usable AS (SELECT * FROM checked WHERE e1 IS NULL AND e3 IS NULL),
people AS (SELECT sheet_id, role, unnest("groups") AS principal, 'group' AS type FROM usable
  UNION ALL SELECT sheet_id, role, unnest("users"), 'user' FROM usable),
principals AS (SELECT DISTINCT sheet_id, CASE WHEN role <> '' THEN role ELSE 'role_' || principal END AS role, principal, type FROM people)"""

EXPLODED = f"""{PRINCIPALS},
bound AS (SELECT *, role AS b_role, "users" AS b_users FROM usable WHERE role <> ''
  UNION ALL SELECT * EXCLUDE (u), 'role_' || u AS b_role, [u] AS b_users FROM (SELECT *, unnest("users") AS u FROM usable WHERE role = '')),
x1 AS (SELECT *, unnest(CASE WHEN has_url THEN ['*'] ELSE list_filter({csv_list("database")}, lambda x: lower(x) NOT IN ('nan', 'null', 'none')) END) AS s FROM bound),
x2 AS (SELECT *, unnest(CASE WHEN has_url OR len({csv_list("tables")}) = 0 THEN ['*'] ELSE {csv_list("tables")} END) AS t FROM x1),
x3 AS (SELECT *, unnest(CASE WHEN has_url OR len({csv_list('"columns"')}) = 0 THEN ['*'] ELSE {csv_list('"columns"')} END) AS c FROM x2),
exploded AS (SELECT sheet_id, row_index, CASE WHEN has_url THEN url WHEN s = '*' THEN 'iceberg' WHEN t <> '*' AND c <> '*' THEN 'iceberg.' || s || '.' || t || '.' || c
  WHEN t <> '*' THEN 'iceberg.' || s || '.' || t WHEN c <> '*' THEN 'iceberg.' || s || '.*.' || c ELSE 'iceberg.' || s END AS policy_name,
  CASE WHEN has_url THEN 'url' ELSE 'table' END AS policy_type, CASE WHEN NOT has_url THEN s END AS schema_name, CASE WHEN NOT has_url THEN t END AS table_name,
  CASE WHEN NOT has_url THEN c END AS column_name, b_role AS role, item_type, permissions, "groups", b_users AS "users",
  CASE WHEN e2 IS NULL THEN rowfilter ELSE '' END AS rowfilter, {csv_list("policy_label")} AS labels FROM x3)"""

MEMBERS = f"""{EXPLODED},
members AS (SELECT sheet_id, policy_name, role, item_type, 'permission' AS kind, unnest(permissions) AS value FROM exploded
  UNION SELECT sheet_id, policy_name, role, item_type, 'group', unnest("groups") FROM exploded
  UNION SELECT sheet_id, policy_name, role, item_type, 'user', unnest("users") FROM exploded
  UNION SELECT sheet_id, policy_name, role, item_type, 'rowfilter', rowfilter FROM exploded WHERE rowfilter <> ''),
headers AS (SELECT DISTINCT ON (sheet_id, policy_name) sheet_id, policy_name, policy_type, schema_name, table_name, column_name, labels FROM exploded
  ORDER BY sheet_id, policy_name, row_index, schema_name, table_name, column_name)"""


def _filled(spark, d):
    return policy.fill_context(B.sheet(spark, d), block_rows=BLOCK_ROWS)


def _checked(spark, d):
    return policy.check_rows(_filled(spark, d))


def _exploded(spark, d):
    return policy.explode_resources(_checked(spark, d))


def _compiled(spark, d):
    """Policy members and headers over one stored expansion of the sheet."""
    return policy_run.compile_sheet(B.sheet(spark, d), block_rows=BLOCK_ROWS)


def _members(spark, d):
    return policy.policy_members(_exploded(spark, d))


def _role_members(spark, d):
    return policy.role_members(_checked(spark, d))


@query("fill_down_context", f"WITH {FILLED} SELECT sheet_id, row_index, database, url FROM filled")
def fill_down_context(spark, d):
    return _filled(spark, d).select(*KEYS, "row_index", "database", "url")


@query("fill_down_resource", f'WITH {FILLED} SELECT sheet_id, row_index, tables, "columns" FROM filled')
def fill_down_resource(spark, d):
    return _filled(spark, d).select(*KEYS, "row_index", "tables", "columns")


@query("fill_down_label", f"WITH {FILLED} SELECT sheet_id, row_index, policy_label FROM filled")
def fill_down_label(spark, d):
    return _filled(spark, d).select(*KEYS, "row_index", "policy_label")


@query(
    "policy_skipped_rows",
    f"""WITH {CHECKED} SELECT sheet_id, row_index, role, database, url, unnest(list_filter([e1, e2, e3], lambda x: x IS NOT NULL)) AS reason FROM checked""",
)
def policy_skipped_rows(spark, d):
    return policy.skipped_rows(_checked(spark, d))


@query("role_principals", f"WITH {PRINCIPALS} SELECT sheet_id, role, principal, type FROM principals")
def role_principals(spark, d):
    return policy.role_principals(_role_members(spark, d))


@query(
    "policy_explode",
    f"""WITH {EXPLODED} SELECT sheet_id, row_index, policy_name, policy_type, schema_name, table_name, column_name, role, item_type, rowfilter,
    array_to_string("users", ',') AS users_list FROM exploded""",
)
def policy_explode(spark, d):
    return _exploded(spark, d).select(
        *KEYS, "row_index", "policy_name", "policy_type", "schema_name", "table_name", "column_name", "role", "item_type", "rowfilter",
        F.array_join("users", ",").alias("users_list"),
    )


def _list(kind: str) -> str:
    return f"coalesce(string_agg(value, ',' ORDER BY value) FILTER (WHERE kind = '{kind}'), '')"


@query(
    "policy_compile",
    f"""WITH {MEMBERS}, m AS (SELECT sheet_id, policy_name, role, item_type, {_list("permission")} AS permissions, {_list("group")} AS groups_list,
    {_list("user")} AS users_list, count(*) FILTER (WHERE kind = 'rowfilter') AS n, max(value) FILTER (WHERE kind = 'rowfilter') AS f FROM members GROUP BY ALL)
    SELECT m.* EXCLUDE (n, f, permissions), CASE WHEN n > 1 THEN '' ELSE permissions END AS permissions, n > 1 AS rowfilter_conflict, CASE WHEN n = 1 THEN f ELSE '' END AS rowfilter, policy_type, schema_name,
    array_to_string(labels, ',') AS labels FROM m JOIN headers USING (sheet_id, policy_name)""",
)
def policy_compile(spark, d):
    compiled = _compiled(spark, d)
    merged = policy.merge_policy_roles(compiled.members)
    headers = compiled.headers.select(
        *KEYS, "policy_name", "policy_type", "schema_name", F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels")
    )
    return merged.join(headers, [*KEYS, "policy_name"]).select(
        *KEYS,
        *ROLE,
        F.array_join("permissions", ",").alias("permissions"),
        F.array_join("groups", ",").alias("groups_list"),
        F.array_join("users", ",").alias("users_list"),
        "rowfilter_conflict",
        "rowfilter",
        "policy_type",
        "schema_name",
        "labels",
    )


@query(
    "rowfilter_conflicts",
    f"""WITH {MEMBERS} SELECT 'role' AS level, sheet_id, policy_name, role, item_type, count(DISTINCT value) AS rowfilter_count FROM members
    WHERE kind = 'rowfilter' GROUP BY ALL HAVING count(DISTINCT value) > 1
    UNION ALL SELECT 'policy', sheet_id, policy_name, NULL, NULL, count(DISTINCT value) FROM members WHERE kind = 'rowfilter' GROUP BY ALL HAVING count(DISTINCT value) > 1""",
)
def rowfilter_conflicts(spark, d):
    members = _compiled(spark, d).members
    by_role = policy.rowfilter_conflicts(members).withColumn("level", F.lit("role"))
    by_policy = policy.rowfilter_conflicts(members, level="policy").withColumn("level", F.lit("policy"))
    return by_role.unionByName(by_policy, allowMissingColumns=True)


@query(
    "policy_initial_status",
    f"""WITH {MEMBERS}, flat AS (SELECT DISTINCT sheet_id, policy_name, kind, value FROM members WHERE kind <> 'group'
    UNION SELECT sheet_id, policy_name, 'role', role FROM members),
    s AS (SELECT sheet_id, policy_name, {_list("user")} AS users_list, {_list("role")} AS groups_list, {_list("permission")} AS permissions_list,
    count(*) FILTER (WHERE kind = 'rowfilter') AS n, max(value) FILTER (WHERE kind = 'rowfilter') AS f FROM flat GROUP BY ALL)
    SELECT * EXCLUDE (n, f), policy_name AS policy_id, CASE WHEN n = 1 THEN f END AS rowfilter, 'RUNNING' AS status FROM s""",
)
def policy_initial_status(spark, d):
    return policy.policy_initial_status(_compiled(spark, d).members).select(
        *KEYS, "policy_name", "policy_id", "rowfilter", "status",
        *[F.array_join(c, ",").alias(f"{c}_list") for c in ("users", "groups", "permissions")],
    )


# mappings the identity service reports: a role's own group, and users of even number
MAPPED_ROWS = (
    "inline(array(named_struct('role', 'role_' || (user_id % 40), 'principal', 'g' || (user_id % 25), 'type', 'group'), "
    "named_struct('role', 'role_' || (user_id % 40), 'principal', 'u' || (user_id - user_id % 2), 'type', 'user'), "
    "named_struct('role', 'role_u' || (user_id - user_id % 2), 'principal', 'u' || (user_id - user_id % 2), 'type', 'user')))"
)
MAPPING = f"""{MEMBERS}, mappings AS (SELECT DISTINCT 'role_' || (user_id % 40) AS role, 'g' || (user_id % 25) AS principal, 'group' AS type FROM events
  UNION SELECT 'role_' || (user_id % 40), 'u' || (user_id - user_id % 2), 'user' FROM events
  UNION SELECT 'role_u' || (user_id - user_id % 2), 'u' || (user_id - user_id % 2), 'user' FROM events),
mapped AS (SELECT m.* FROM members m JOIN mappings p ON m.role = p.role AND m.value = p.principal AND m.kind = p.type),
kept AS (SELECT DISTINCT sheet_id, policy_name, role, item_type FROM mapped),
applied AS (SELECT * FROM mapped UNION ALL SELECT m.* FROM members m JOIN kept USING (sheet_id, policy_name, role, item_type) WHERE m.kind NOT IN ('group', 'user'))"""


def _mappings(spark, d):
    return B.table(spark, d, "events").selectExpr(MAPPED_ROWS)


@query("principal_filter", f"WITH {MAPPING} SELECT * FROM applied")
def principal_filter(spark, d):
    return policy.apply_principal_mapping(_compiled(spark, d).members, _mappings(spark, d))


@query(
    "principal_excluded",
    f"""WITH {MAPPING} SELECT DISTINCT m.sheet_id, m.policy_name, m.role, m.item_type,
    (m.sheet_id, m.policy_name) NOT IN (SELECT (sheet_id, policy_name) FROM kept) AS policy_failed FROM members m
    WHERE (m.sheet_id, m.policy_name, m.role, m.item_type) NOT IN (SELECT (sheet_id, policy_name, role, item_type) FROM kept)""",
)
def principal_excluded(spark, d):
    return policy.principal_excluded(_compiled(spark, d).members, _mappings(spark, d))


SUPPORTED = ["select", "insert", "use", "show", "write", "read"]
ITEMS = f"""{MAPPING},
clashes AS (SELECT sheet_id, policy_name, role, item_type FROM applied WHERE kind = 'rowfilter' GROUP BY ALL HAVING count(DISTINCT value) > 1),
typed AS (SELECT a.*, policy_type, schema_name, table_name FROM applied a JOIN headers USING (sheet_id, policy_name)
  WHERE (sheet_id, policy_name) NOT IN (SELECT (sheet_id, policy_name) FROM clashes)),
granted AS (SELECT *, unnest(list_filter(CASE WHEN policy_type = 'url' THEN {url_access_list("[value]")} ELSE {access_list("[value]")} END,
  lambda x: list_contains({words(SUPPORTED)}, x))) AS access FROM typed WHERE kind = 'permission'),
items AS (SELECT DISTINCT sheet_id, policy_name, policy_name AS target_policy, item_type AS item_list, role, access, CAST(NULL AS VARCHAR) AS filter_expr FROM granted
  UNION SELECT sheet_id, policy_name, 'iceberg' || CASE WHEN schema_name = '*' THEN '' ELSE '.' || schema_name END
  || CASE WHEN table_name = '*' THEN '' ELSE '.' || table_name END || '__rowfilter', 'rowfilter', role, 'select', value
  FROM typed WHERE kind = 'rowfilter' AND item_type = 'allow')"""


def _items(compiled, mappings):
    applied = policy.apply_principal_mapping(compiled.members, mappings)
    return policy.policy_items(applied, compiled.headers, SUPPORTED)


@query("policy_items", f"WITH {ITEMS} SELECT * FROM items")
def policy_items(spark, d):
    return _items(_compiled(spark, d), _mappings(spark, d))


# policies the service already has: those of even users' databases
EXISTING = "SELECT DISTINCT 'iceberg.db' || user_id AS policy_name, 'P' || user_id AS policy_id FROM events WHERE event_type IN ('view', 'click')"
PLAN = f"""{ITEMS}, existing AS ({EXISTING}),
facts AS (SELECT sheet_id, policy_name, count(*) FILTER (WHERE item_list IN ('allow', 'deny')) AS grants,
  max(target_policy) FILTER (WHERE item_list = 'rowfilter') AS companion FROM items GROUP BY ALL),
plan AS (SELECT h.sheet_id, h.policy_name, h.policy_type, CASE WHEN coalesce(grants, 0) = 0 THEN 'failed' WHEN policy_id IS NOT NULL THEN 'updated' ELSE 'created' END AS action,
  CASE WHEN coalesce(grants, 0) > 0 THEN policy_id END AS policy_id, CASE WHEN coalesce(grants, 0) > 0 THEN companion END AS rowfilter_policy_name,
  CASE WHEN (h.sheet_id, h.policy_name) IN (SELECT (sheet_id, policy_name) FROM clashes) THEN 'conflicting row filters'
  WHEN coalesce(grants, 0) = 0 THEN 'no supported access types remain' END AS error
  FROM headers h LEFT JOIN facts USING (sheet_id, policy_name) LEFT JOIN existing USING (policy_name))"""


def _plan(spark, d, compiled=None):
    compiled = compiled or _compiled(spark, d)
    events = B.table(spark, d, "events").where("event_type IN ('view', 'click')")
    existing = events.selectExpr("'iceberg.db' || user_id AS policy_name", "'P' || user_id AS policy_id").distinct()
    return policy_run.sync_plan(compiled, _mappings(spark, d), existing, SUPPORTED)


@query("policy_sync_plan", f"WITH {PLAN} SELECT * FROM plan")
def policy_sync_plan(spark, d):
    return _plan(spark, d)


STATUS = f"""{PLAN}, object_rows AS (SELECT sheet_id, 'policy' AS object_type, policy_name AS object_name, CASE WHEN action <> 'failed' THEN coalesce(policy_id, '') END AS policy_id,
  CASE WHEN action <> 'failed' THEN policy_name END AS policy_name, upper(action) AS status, coalesce(error, '') AS error_message, 0 AS sequence FROM plan
  UNION ALL SELECT sheet_id, 'policy', rowfilter_policy_name, coalesce(policy_id, ''), policy_name, upper(action), coalesce(error, ''), 1 FROM plan WHERE rowfilter_policy_name IS NOT NULL)"""


@query("policy_status_rows", f"WITH {STATUS} SELECT * FROM object_rows")
def policy_status_rows(spark, d):
    return principals.policy_status_rows(_plan(spark, d))


@query(
    "policy_final_status",
    f"""WITH {STATUS}, roles AS (SELECT sheet_id, policy_name, string_agg(DISTINCT role, ',' ORDER BY role) AS all_roles FROM members GROUP BY ALL),
    a AS (SELECT sheet_id, policy_name, string_agg(DISTINCT role, ',' ORDER BY role) AS r FROM kept GROUP BY ALL),
    x AS (SELECT sheet_id, policy_name, string_agg(DISTINCT role, ', ' ORDER BY role) AS r FROM
      (SELECT DISTINCT sheet_id, policy_name, role, item_type FROM members EXCEPT SELECT * FROM kept) GROUP BY ALL),
    o AS (SELECT sheet_id, regexp_replace(object_name, '__rowfilter$', '') AS policy_name, max(status) FILTER (WHERE NOT ends_with(object_name, '__rowfilter')) AS status,
      max(error_message) FILTER (WHERE NOT ends_with(object_name, '__rowfilter')) AS msg,
      max(policy_id) FILTER (WHERE NOT ends_with(object_name, '__rowfilter')) AS pid,
      count(*) FILTER (WHERE NOT ends_with(object_name, '__rowfilter')) AS own FROM object_rows GROUP BY ALL)
    SELECT h.sheet_id, h.policy_name, CASE WHEN coalesce(own, 0) > 0 THEN coalesce(pid, '') ELSE h.policy_name END AS policy_id, coalesce(a.r, all_roles) AS groups_list,
    coalesce(o.status, 'RUNNING') AS status, concat_ws(' | ', nullif(coalesce(msg, ''), ''),
    CASE WHEN x.r IS NOT NULL AND coalesce(o.status, 'RUNNING') <> 'FAILED' THEN 'excluded roles without a mapped principal: ' || x.r END) AS error_message
    FROM headers h JOIN roles USING (sheet_id, policy_name) LEFT JOIN a USING (sheet_id, policy_name) LEFT JOIN x USING (sheet_id, policy_name)
    LEFT JOIN o USING (sheet_id, policy_name)""",
)
def policy_final_status(spark, d):
    compiled, mappings = _compiled(spark, d), _mappings(spark, d)
    applied = policy.mapped_members(compiled.members, mappings).select(*KEYS, *ROLE)
    excluded = policy.principal_excluded(compiled.members, mappings)
    objects = principals.policy_status_rows(_plan(spark, d, compiled))
    initial = policy.policy_initial_status(compiled.members)
    final = lineage.policy_final_status(initial, objects, applied, excluded, ("sheet_id",))
    return final.select(*KEYS, "policy_name", "policy_id", F.array_join("groups", ",").alias("groups_list"), "status", "error_message")


# identity snapshots, all taken from customers and suppliers
HAVE_ROLES = "SELECT DISTINCT 'role_' || (s_suppkey % 30) AS role FROM supplier"
HAVE_GROUPS = "SELECT DISTINCT 'g' || s_nationkey AS \"group\" FROM supplier WHERE s_nationkey <> 3"
HAVE_USERS = "SELECT DISTINCT 'u' || c_custkey AS \"user\" FROM customer WHERE c_nationkey <> 5"
HAVE_MAPS = "SELECT DISTINCT 'role_' || (c_custkey % 40) AS role, 'g' || c_nationkey AS principal, 'group' AS type FROM customer WHERE c_acctbal > 0"
SYNC = f"""{PRINCIPALS}, all_roles AS (SELECT DISTINCT sheet_id, role FROM checked WHERE e1 IS NULL AND role <> '' UNION SELECT sheet_id, role FROM principals),
wanted AS (SELECT DISTINCT role, principal, type FROM principals),
known AS (SELECT "group" AS principal, 'group' AS type FROM ({HAVE_GROUPS}) UNION SELECT "user", 'user' FROM ({HAVE_USERS})),
w AS (SELECT w.*, k.principal IS NOT NULL AS is_known, m.role IS NOT NULL AS is_mapped FROM wanted w LEFT JOIN known k ON w.principal = k.principal AND w.type = k.type
  LEFT JOIN ({HAVE_MAPS}) m ON w.role = m.role AND w.principal = m.principal AND w.type = m.type),
sync AS (SELECT 'role' AS object_type, role AS object_name, CASE WHEN role IN ({HAVE_ROLES}) THEN 'ALREADY_EXISTS' ELSE 'CREATED' END AS status, '' AS error_message
  FROM (SELECT DISTINCT role FROM all_roles)
  UNION ALL SELECT DISTINCT 'keycloak_group', principal, CASE WHEN is_known THEN 'ALREADY_EXISTS' ELSE 'FAILED' END,
  CASE WHEN is_known THEN '' ELSE 'group ''' || principal || ''' does not exist' END FROM w WHERE type = 'group'
  UNION ALL SELECT 'mapping', role || '->' || principal || ' (' || type || ')', CASE WHEN NOT is_known THEN 'FAILED' WHEN is_mapped THEN 'ALREADY_EXISTS' ELSE 'CREATED' END,
  CASE WHEN is_known THEN '' ELSE type || ' ''' || principal || ''' does not exist' END FROM w)"""


def _sync(spark, d, members):
    supplier, customer = B.table(spark, d, "supplier"), B.table(spark, d, "customer")
    return principals.principal_sync_plan(
        policy.roles(members),
        policy.role_principals(members),
        supplier.selectExpr("'role_' || (s_suppkey % 30) AS role"),
        supplier.where("s_nationkey <> 3").selectExpr("'g' || s_nationkey AS `group`"),
        customer.where("c_nationkey <> 5").selectExpr("'u' || c_custkey AS user"),
        customer.where("c_acctbal > 0").selectExpr("'role_' || (c_custkey % 40) AS role", "'g' || c_nationkey AS principal", "'group' AS type"),
    )


@query("principal_sync_plan", f"WITH {SYNC} SELECT * FROM sync")
def principal_sync_plan(spark, d):
    return _sync(spark, d, stored(_role_members(spark, d), "role_members"))


@query(
    "principal_status_rows",
    f"""WITH {SYNC} SELECT 'run_1' AS run_id, *, 1 AS attempt FROM sync
    UNION ALL SELECT DISTINCT 'run_2', object_type, object_name, 'FAILED', 'identity service connection failed: timeout', 3 FROM sync""",
)
def principal_status_rows(spark, d):
    members = stored(_role_members(spark, d), "role_members")
    down = principals.all_failed_rows(policy.roles(members), policy.role_principals(members), "run_2", "timeout", 3)
    return principals.combine_status(principals.status_rows(_sync(spark, d, members), "run_1"), down)


OBJECTS = f"""{SYNC}, agroups AS (SELECT 'ranger_group' AS object_type, role AS object_name,
  CASE WHEN role IN (SELECT 'role_' || (c_custkey % 25) FROM customer) THEN 'ALREADY_EXISTS' ELSE 'CREATED' END AS status, '' AS error_message FROM (SELECT DISTINCT role FROM all_roles)),
objects AS (SELECT * FROM sync UNION ALL SELECT * FROM agroups)"""


def _objects(spark, d):
    members = stored(_role_members(spark, d), "role_members")
    return principals.combine_status(_sync(spark, d, members), _access_groups(spark, d, members))


def _access_groups(spark, d, members):
    have = B.table(spark, d, "customer").selectExpr("'role_' || (c_custkey % 25) AS `group`")
    return principals.access_group_rows(policy.roles(members), have)


@query("access_group_rows", f"WITH {OBJECTS} SELECT * FROM agroups")
def access_group_rows(spark, d):
    return _access_groups(spark, d, _role_members(spark, d))


@query("object_type_counts", f"WITH {OBJECTS} SELECT object_type, count(*) AS object_count FROM objects GROUP BY ALL")
def object_type_counts(spark, d):
    return principals.object_type_counts(_objects(spark, d))


def _n(kind: str, status: str) -> str:
    return f"count(*) FILTER (WHERE object_type = '{kind}' AND status = '{status}')"


POLICY_OBJECTS = "count(*) FILTER (WHERE object_type = 'policy' AND status = '{0}' AND NOT ends_with(object_name, '__rowfilter'))"


RUN_OBJECTS = f"""WITH {OBJECTS}, all_rows AS (SELECT 'run_1' AS run_id, object_type, object_name, status FROM objects)"""


@query(
    "policy_run_metrics",
    f"""{RUN_OBJECTS} SELECT run_id, {_n("ranger_group", "CREATED")} AS groups_created, {_n("ranger_group", "ALREADY_EXISTS")} AS groups_existing,
    {POLICY_OBJECTS.format("CREATED")} AS policies_created, {POLICY_OBJECTS.format("UPDATED")} AS policies_updated, {POLICY_OBJECTS.format("FAILED")} AS policies_failed,
    {_n("role", "CREATED")} AS roles_created, {_n("role", "ALREADY_EXISTS")} AS roles_existing, {_n("mapping", "CREATED")} AS mappings_created,
    {_n("mapping", "ALREADY_EXISTS")} AS mappings_existing, count(*) AS total_objects, count(*) FILTER (WHERE status <> 'FAILED') AS successful_objects,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_objects,
    CASE WHEN count(*) FILTER (WHERE status = 'FAILED') = 0 THEN 'COMPLETED' ELSE 'PARTIAL_FAILURE' END AS overall_status FROM all_rows GROUP BY run_id""",
)
def policy_run_metrics(spark, d):
    return principals.policy_run_metrics(_objects(spark, d).withColumn("run_id", F.lit("run_1")))


@query(
    "report_summary_policy",
    f"""{RUN_OBJECTS} SELECT run_id, count(*) AS total, count(*) FILTER (WHERE status <> 'FAILED') AS successful, count(*) FILTER (WHERE status = 'FAILED') AS failed
    FROM all_rows GROUP BY ALL""",
)
def report_summary_policy(spark, d):
    return report.report_summary(_objects(spark, d).withColumn("run_id", F.lit("run_1")), "policy")


# item merges: items a service holds per brand and nation, new ones from parts
HELD = "SELECT 'p' || s_nationkey AS policy_name, CASE WHEN s_acctbal > 5000 THEN 'deny' ELSE 'allow' END AS item_list, CAST(s_suppkey AS INT) AS item_index, ['g' || (s_suppkey % 9), 'g' || (s_suppkey % 4)] AS groups, ['u' || s_suppkey] AS users, ['select', CASE WHEN s_acctbal > 0 THEN 'use' ELSE 'drop' END] AS accesses FROM supplier"
FRESH = "SELECT DISTINCT 'p' || (p_partkey % 30) AS policy_name, CASE WHEN p_size > 40 THEN 'deny' ELSE 'allow' END AS item_list, 'g' || (p_size % 12) AS \"group\", CAST([] AS VARCHAR[]) AS users, [CASE WHEN p_type = 'PROMO' THEN 'insert' ELSE 'show' END] AS accesses FROM part"


def _duck_to_spark(sql: str) -> str:
    """The same derivation with Spark's array syntax."""
    return (
        sql.replace("CAST([] AS VARCHAR[])", "CAST(array() AS ARRAY<STRING>)")
        .replace('"group"', "`group`")
        .replace("[", "array(")
        .replace("]", ")")
    )


def _derived(spark, d, sql: str, name: str):
    body, source = sql.rsplit(" FROM ", 1)
    distinct = body.startswith("SELECT DISTINCT ")
    columns = _duck_to_spark(body.removeprefix("SELECT ").removeprefix("DISTINCT "))
    view = B.table(spark, d, source)
    out = spark.sql(f"SELECT {columns} FROM {{{name}}}", **{name: view})
    return out.distinct() if distinct else out


@query(
    "policy_item_merge",
    f"""WITH e AS ({HELD}), n AS ({FRESH}),
    own AS (SELECT policy_name, item_list, g AS "group", max(item_index) AS item_index FROM (SELECT *, unnest(groups) AS g FROM e) GROUP BY ALL),
    placed AS (SELECT n.*, own.item_index FROM n LEFT JOIN own USING (policy_name, item_list, "group")),
    added AS (SELECT policy_name, item_list, item_index, CASE WHEN item_index IS NULL THEN "group" END AS ng, list_distinct(flatten(list(accesses))) AS acc FROM placed GROUP BY ALL)
    SELECT e.policy_name, e.item_list, e.item_index, array_to_string(list_sort(groups), ',') AS groups_list, array_to_string(list_sort(users), ',') AS users_list,
    array_to_string(list_sort(list_distinct(list_concat(accesses, coalesce(acc, [])))), ',') AS accesses
    FROM e LEFT JOIN added a ON e.policy_name = a.policy_name AND e.item_list = a.item_list AND e.item_index = a.item_index
    UNION ALL SELECT policy_name, item_list, item_index, ng, '', array_to_string(list_sort(acc), ',') FROM added WHERE ng IS NOT NULL""",
)
def policy_item_merge(spark, d):
    merged = policy.merge_policy_items(_derived(spark, d, HELD, "supplier"), _derived(spark, d, FRESH, "part"))
    return merged.select(
        "policy_name", "item_list", "item_index",
        F.array_join("groups", ",").alias("groups_list"),
        F.array_join("users", ",").alias("users_list"),
        F.array_join("accesses", ",").alias("accesses"),
    )


RF_HELD = "SELECT DISTINCT 'p' || s_nationkey AS policy_name, 'g' || (s_suppkey % 9) AS \"group\", ['u' || s_nationkey] AS users, ['select'] AS accesses, 'old = ' || s_nationkey AS filter_expr FROM supplier"
RF_FRESH = "SELECT DISTINCT 'p' || (p_partkey % 10) AS policy_name, 'g' || (p_partkey % 12) AS \"group\", ['u' || (p_partkey % 10)] AS users, ['select'] AS accesses, 'new = ' || (p_partkey % 60) AS filter_expr FROM part"


@query(
    "rowfilter_merge",
    f"""WITH e AS ({RF_HELD}), n AS (SELECT DISTINCT ON (policy_name, "group") * FROM ({RF_FRESH}) ORDER BY policy_name, "group", filter_expr DESC),
    upd AS (SELECT DISTINCT 'p' || (n_nationkey % 15) AS policy_name FROM nation),
    k AS (SELECT * FROM e WHERE policy_name NOT IN (SELECT policy_name FROM upd WHERE policy_name NOT IN (SELECT policy_name FROM n)))
    SELECT coalesce(k.policy_name, n.policy_name) AS policy_name, coalesce(k."group", n."group") AS "group",
    array_to_string(list_sort(list_distinct(list_concat(coalesce(k.users, []), coalesce(n.users, [])))), ',') AS users_list,
    coalesce(n.filter_expr, k.filter_expr) AS filter_expr FROM k FULL OUTER JOIN n ON k.policy_name = n.policy_name AND k."group" = n."group" """,
)
def rowfilter_merge(spark, d):
    fresh = _derived(spark, d, RF_FRESH, "part")
    latest = (
        fresh.groupBy("policy_name", "group")
        .agg(F.max(F.struct("filter_expr", "users", "accesses")).alias("x"))
        .select("policy_name", "group", "x.users", "x.accesses", "x.filter_expr")
    )
    updated = B.table(spark, d, "nation").selectExpr("'p' || (n_nationkey % 15) AS policy_name")
    merged = policy.merge_rowfilter_items(_derived(spark, d, RF_HELD, "supplier"), latest, updated)
    return merged.select("policy_name", "group", F.array_join("users", ",").alias("users_list"), "filter_expr")


# lineage: policies and objects of several runs, taken from events
RUN = "'run_' || event_type"
POLICIES: B.Columns = [
    ("run_id", RUN),
    ("policy_name", "CASE WHEN user_id % 29 = 0 THEN ' ' ELSE 'pol_' || user_id END"),
    ("policy_id", "CASE WHEN user_id % 31 = 0 THEN NULL ELSE 'id' || user_id END"),
    ("status", "CASE user_id % 7 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'UPDATED' ELSE 'CREATED' END"),
    ("g1", "'role_' || (user_id % 11)"),
    ("g2", "'team ' || (user_id % 4)"),
    ("u1", "CASE WHEN user_id % 6 = 0 THEN ' ' ELSE 'u' || (user_id % 50) END"),
]
POL = f"pol AS (SELECT DISTINCT * FROM ({B.select_sql(POLICIES, 'events')})), good AS (SELECT * FROM pol WHERE status IN ('CREATED', 'UPDATED') AND trim(coalesce(policy_name, '')) <> '' AND trim(coalesce(policy_id, '')) <> '')"


def _policies(spark, d):
    rows = B.derive(B.table(spark, d, "events"), POLICIES).distinct()
    return rows.select("run_id", "policy_name", "policy_id", "status", F.array("g1", "g2").alias("groups"), F.array("u1").alias("users"))


OBJECT_ROWS: B.Columns = [
    ("run_id", RUN),
    ("object_type", f"CASE WHEN {B.K} < 20 THEN 'policy' WHEN {B.K} < 40 THEN 'mapping' WHEN {B.K} < 60 THEN 'role' WHEN {B.K} < 80 THEN 'ranger_group' ELSE 'keycloak_group' END"),
    ("object_name", f"CASE WHEN {B.K} < 10 THEN 'pol_' || user_id WHEN {B.K} < 20 THEN 'pol_' || user_id || '__rowfilter' WHEN {B.K} < 30 THEN 'role_' || (user_id % 11) || '->team ' || (user_id % 5) || ' (group)' WHEN {B.K} < 40 THEN 'role_' || (user_id % 13) || '->u' || (user_id % 60) || ' (user)' WHEN {B.K} < 70 THEN 'role_' || (user_id % 17) WHEN {B.K} < 80 THEN 'role_' || (user_id % 13) ELSE 'team ' || (user_id % 6) END"),
    ("policy_name", "CASE WHEN user_id % 23 = 0 THEN 'kept' WHEN user_id % 3 = 0 THEN '' END"),
    ("policy_id", "CASE WHEN user_id % 23 = 0 THEN 'kept_id' END"),
]
OBJ = f"""obj AS (SELECT run_id, object_type, object_name, max(policy_name) AS policy_name, max(policy_id) AS policy_id FROM ({B.select_sql(OBJECT_ROWS, B.KEYED_EVENTS)}) GROUP BY ALL)"""


def _object_rows(spark, d):
    rows = B.derive(B.keyed_events(spark, d), OBJECT_ROWS)
    return rows.groupBy("run_id", "object_type", "object_name").agg(
        F.max("policy_name").alias("policy_name"), F.max("policy_id").alias("policy_id")
    )


def _agg(source: str, key: str) -> str:
    return (
        f"SELECT run_id, {key}, string_agg(DISTINCT policy_name, ', ' ORDER BY policy_name) AS policy_name, "
        f"string_agg(DISTINCT policy_id, ', ' ORDER BY policy_id) AS policy_id FROM {source} GROUP BY run_id, {key}"
    )


LINKS = f"""{POL}, links AS (SELECT run_id, unnest([g1, g2, u1]) AS principal, policy_name, policy_id FROM good),
by_principal AS ({_agg("(SELECT * FROM links WHERE trim(principal) <> '')", "principal")}),
names AS (SELECT run_id, unnest([policy_name, policy_name || '__rowfilter']) AS object_name, policy_name, policy_id FROM good)"""


@query("policy_object_names", f"WITH {LINKS} SELECT run_id, object_name, policy_name, policy_id FROM names")
def policy_object_names(spark, d):
    return lineage.policy_object_names(_policies(spark, d))


@query("principal_policies", f"WITH {LINKS} SELECT * FROM by_principal")
def principal_policies(spark, d):
    return lineage.principal_policies(_policies(spark, d))


ROLE_OF = "trim(regexp_extract(object_name, '^(.+?)->', 1))"
GROUP_OF = "trim(regexp_extract(object_name, '->([^(]+)\\s*\\(group\\)$', 1))"
PRINCIPAL_OF = "trim(regexp_extract(object_name, '->([^(]+)\\s*\\((group|user)\\)$', 1))"


def _label_source(objects: str, key: str) -> str:
    return _agg(
        f"(SELECT run_id, {key} AS name, policy_name, policy_id FROM {objects} WHERE object_type = 'mapping' AND coalesce(policy_name, '') <> '' AND {key} <> '')",
        "name",
    )


def _fill(objects: str, source: str, types: str, key: str = "object_name") -> str:
    is_open = "(coalesce(o.policy_id, '') = '' OR coalesce(o.policy_name, '') = '') AND s.policy_name IS NOT NULL"
    return (
        f"SELECT o.run_id, o.object_type, o.object_name, CASE WHEN {is_open} THEN s.policy_name ELSE o.policy_name END AS policy_name, "
        f"CASE WHEN {is_open} THEN s.policy_id ELSE o.policy_id END AS policy_id FROM (SELECT *, {key} AS k FROM {objects}) o "
        f"LEFT JOIN {source} s ON o.run_id = s.run_id AND o.k = s.name AND o.object_type IN ({types})"
    )


STEPS = f"""{LINKS}, {OBJ},
s1 AS (SELECT run_id, object_name AS name, min(policy_name) AS policy_name, min(policy_id) AS policy_id FROM names GROUP BY ALL),
s2 AS (SELECT run_id, principal AS name, policy_name, policy_id FROM by_principal),
o1 AS ({_fill("obj", "s1", "'policy'")}),
o2 AS ({_fill("o1", "s2", "'ranger_group', 'keycloak_group'")}),
o3 AS ({_fill("o2", "s2", "'mapping'", PRINCIPAL_OF)}),
s4 AS ({_label_source("o3", ROLE_OF)}),
o4 AS ({_fill("o3", "s4", "'role'")}),
s5 AS (SELECT run_id, object_name AS name, policy_name, policy_id FROM o4 WHERE object_type = 'role' AND coalesce(policy_name, '') <> ''),
o5 AS ({_fill("o4", "s5", "'ranger_group'")}),
s6 AS ({_label_source("o5", GROUP_OF)}),
o6 AS ({_fill("o5", "s6", "'keycloak_group'")})"""
SHOWN = "run_id, object_type, object_name, policy_name, policy_id"


@query("lineage_policy", f"WITH {STEPS} SELECT {SHOWN} FROM o1")
def lineage_policy(spark, d):
    return lineage.backfill_policy_objects(_object_rows(spark, d), _policies(spark, d))


@query("lineage_groups", f"WITH {STEPS}, z AS ({_fill('obj', 's2', chr(39) + 'ranger_group' + chr(39) + ', ' + chr(39) + 'keycloak_group' + chr(39))}) SELECT * FROM z")
def lineage_groups(spark, d):
    return lineage.backfill_groups(_object_rows(spark, d), _policies(spark, d))


@query("lineage_mappings", f"WITH {STEPS}, z AS ({_fill('obj', 's2', chr(39) + 'mapping' + chr(39), PRINCIPAL_OF)}) SELECT * FROM z")
def lineage_mappings(spark, d):
    return lineage.backfill_mappings(_object_rows(spark, d), _policies(spark, d))


@query("label_policies", f"WITH {STEPS} SELECT 'role' AS kind, * FROM s4 UNION ALL SELECT 'group', * FROM s6")
def label_policies(spark, d):
    mapped = lineage.backfill_mappings(_object_rows(spark, d), _policies(spark, d))
    by_role = lineage.label_policies(mapped, "role").withColumn("kind", F.lit("role"))
    return by_role.unionByName(lineage.label_policies(mapped, "group").withColumn("kind", F.lit("group")))


@query("lineage_roles", f"WITH {STEPS}, m AS ({_fill('obj', 's2', chr(39) + 'mapping' + chr(39), PRINCIPAL_OF)}), z AS ({_fill('m', 's4', chr(39) + 'role' + chr(39))}) SELECT * FROM z")
def lineage_roles(spark, d):
    return lineage.backfill_roles(lineage.backfill_mappings(_object_rows(spark, d), _policies(spark, d)))


@query("lineage_all", f"WITH {STEPS} SELECT {SHOWN} FROM o6")
def lineage_all(spark, d):
    return lineage.backfill_all(_object_rows(spark, d), _policies(spark, d))


@query("lineage_role_groups", f"WITH {STEPS}, m AS ({_fill('obj', 's2', chr(39) + 'mapping' + chr(39), PRINCIPAL_OF)}), r AS ({_fill('m', 's4', chr(39) + 'role' + chr(39))}), z AS (SELECT run_id, object_name AS name, policy_name, policy_id FROM r WHERE object_type = 'role' AND coalesce(policy_name, '') <> ''), y AS ({_fill('r', 'z', chr(39) + 'ranger_group' + chr(39))}), x AS ({_fill('y', 's6', chr(39) + 'keycloak_group' + chr(39))}) SELECT * FROM x")
def lineage_role_groups(spark, d):
    mapped = lineage.backfill_mappings(_object_rows(spark, d), _policies(spark, d))
    return lineage.backfill_identity_groups(lineage.backfill_role_groups(lineage.backfill_roles(mapped)))




SEG = 1000


def _segment_sql(rows: str, keys: str, value: str, order: str | None = None) -> str:
    distinct = "DISTINCT " if order is None else ""
    by = order or value
    return (
        f"SELECT {keys}, segment, array_to_string(list({value} ORDER BY {by}), '|') AS members FROM (SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY {by}) - 1) // {SEG} AS segment "
        f"FROM (SELECT {distinct}{keys}, {value}{', ' + order if order else ''} FROM ({rows}) WHERE {value} IS NOT NULL)) GROUP BY {keys}, segment"
    )


def _text(df):
    return df.withColumn("members", F.array_join("values", "|")).drop("values")


@query("principal_policy_segments", f"WITH {LINKS} " + _segment_sql("SELECT * FROM links WHERE trim(principal) <> ''", "run_id, principal", "policy_name"))
def principal_policy_segments(spark, d):
    return _text(lineage.policy_segments(lineage.principal_links(_policies(spark, d)), ["run_id", "principal"]))


@query(
    "policy_member_segments",
    f"WITH {MEMBERS}, flat AS (SELECT sheet_id, policy_name, kind, value FROM members WHERE kind <> 'group' UNION SELECT sheet_id, policy_name, 'role', role FROM members) "
    + _segment_sql("SELECT * FROM flat", "sheet_id, policy_name, kind", "value"),
)
def policy_member_segments(spark, d):
    return _text(policy.member_segments(_members(spark, d)))


# every policy of a run as one list: lists that are long however few principals there are
@query("run_policy_segments", f"WITH {LINKS} " + _segment_sql("SELECT run_id, policy_name || ' ' || principal AS member FROM links WHERE trim(principal) <> ''", "run_id", "member"))
def run_policy_segments(spark, d):
    links = lineage.principal_links(_policies(spark, d)).select("run_id", F.concat_ws(" ", "policy_name", "principal").alias("member"))
    return _text(windows.segments(links, ["run_id"], "member"))
