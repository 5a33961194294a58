"""Access-policy compiler: sheet rows -> policies, role members, principals and audit rows.

A policy is kept flat while it is worked on: ``members`` has one row per
(sheet, policy, role, item_type, kind, value) with kind permission / group / user / rowfilter.
Flat rows dedupe with map-side combine and spread a hot policy over all tasks; lists are only
built at the end, from already distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import access as A
from lakeshift.functions import cells as C
from lakeshift.operators.windows import DEFAULT_BLOCK_ROWS, fill_down, segments

KEYS = ("sheet_id",)
ROLE = ("policy_name", "role", "item_type")


def _is_url(c: str) -> Column:
    return ~C.null_like(c) & ~C.strip(c).isin("-", "*")


def fill_context(
    sheet: DataFrame, keys: Sequence[str] = KEYS, order: str = "row_index", block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Fill resource columns down the sheet.

    A row with a database opens a table block: it clears the url and resets tables and columns to
    ``*``. A row with a url but no database opens a url block and clears the database. Labels are
    never reset.
    """
    # each cell is stripped once: the text of a cell that holds one, else null
    cells = ("database", "url", "tables", "columns", "policy_label")
    stripped = sheet.withColumns({f"_v_{c}": C.cell_str(c) for c in cells})
    value = {c: F.col(f"_v_{c}") for c in cells}
    new_db, new_url = value["database"].isNotNull(), value["url"].isNotNull() & ~value["url"].isin("-", "*")

    def listed(c: str) -> Column:
        return F.coalesce(value[c], F.when(new_db, F.lit("*")))

    events = {
        "database": F.when(new_db, value["database"]).when(new_url, F.lit("")),
        "url": F.when(new_url, value["url"]).when(new_db, F.lit("")),
        "tables": listed("tables"),
        "columns": listed("columns"),
        "policy_label": value["policy_label"],
    }
    filled = fill_down(stripped, events, order, keys, block_rows)
    defaults = {"database": "", "url": "", "tables": "*", "columns": "*"}
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()}).select(*sheet.columns)


# Audit texts of rejected or altered rows.
BOTH_OR_NEITHER = "row needs either a database or a url"
URL_ROWFILTER = "row filters do not apply to url policies"
ROWFILTER_IGNORED = "row filter ignored: only allow items may carry one"
GROUPS_WITHOUT_ROLE = "groups need a role"
NO_ROLE_BINDING = "row defines no role binding"
UNSAFE_ROWFILTER = "row filter holds a statement end or a line break"


def check_rows(filled: DataFrame) -> DataFrame:
    """Cleaned item columns plus ``reasons`` (audit texts) and ``rejected``.

    The checks run in sheet-rule order, so each row carries the text of the first rule that
    rejects it, after the warning that does not.
    """
    role = C.cell_str("role", "")
    rowfilter = C.cell_str("rowfilter", "")
    kind = A.item_type("item_type")
    has_db, has_url = ~C.null_like("database"), _is_url("url")
    cleaned = filled.withColumns(
        {
            "role": role,
            "rowfilter": rowfilter,
            "item_type": kind,
            "has_url": has_url,
            "has_db": has_db,
            "groups": C.csv_array("groups"),
            "users": C.csv_array("users"),
            "permissions": A.permission_array("permissions"),
        }
    )
    any_filter = F.col("rowfilter") != ""
    ignored = any_filter & (F.col("item_type") != "allow")
    resource_error = (
        F.when(F.col("has_db") == F.col("has_url"), BOTH_OR_NEITHER)
        .when(F.col("has_url") & any_filter, URL_ROWFILTER)
        .when(~A.rowfilter_valid("rowfilter"), UNSAFE_ROWFILTER)
    )
    no_role = F.col("role") == ""
    binding_error = F.when(no_role & (F.size("groups") > 0), GROUPS_WITHOUT_ROLE).when(
        no_role & (F.size("users") == 0), NO_ROLE_BINDING
    )
    flagged = cleaned.withColumn("resource_error", resource_error).withColumn(
        "binding_error", F.when(F.col("resource_error").isNull(), binding_error)
    )
    reasons = F.array_compact(
        F.array(
            F.col("resource_error"),
            F.when(F.col("resource_error").isNull() & ignored, ROWFILTER_IGNORED),
            F.col("binding_error"),
        )
    )
    return flagged.withColumns(
        {
            "reasons": reasons,
            "rejected": F.col("resource_error").isNotNull() | F.col("binding_error").isNotNull(),
            "rowfilter": F.when(ignored, "").otherwise(F.col("rowfilter")),
        }
    )


def skipped_rows(checked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Audit rows, one per reason."""
    return checked.select(*keys, "row_index", "role", "database", "url", F.explode("reasons").alias("reason"))


def role_members(checked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct (role, principal, type); a role without principals has one row with null principal.

    Rows that only name users get one role per user.
    """
    usable = checked.where(F.col("resource_error").isNull() & F.col("binding_error").isNull())
    own = F.when(F.col("role") != "", F.col("role"))

    def tagged(c: str, kind: str) -> Column:
        return F.transform(
            c,
            lambda p: F.struct(
                F.coalesce(own, F.concat(F.lit("role_"), p)).alias("role"),
                p.alias("principal"),
                F.lit(kind).alias("type"),
            ),
        )

    bare = F.struct(
        own.alias("role"), F.lit(None).cast("string").alias("principal"), F.lit(None).cast("string").alias("type")
    )
    rows = F.concat(tagged("groups", "group"), tagged("users", "user"), F.when(own.isNotNull(), F.array(bare)).otherwise(
        F.array().cast("array<struct<role:string,principal:string,type:string>>")))
    return usable.select(*keys, F.inline(rows)).distinct()


def role_principals(members: DataFrame) -> DataFrame:
    """The (role, principal, type) rows of :func:`role_members`."""
    return members.where(F.col("principal").isNotNull())


def roles(members: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct roles, also those without any principal."""
    return members.select(*keys, "role").distinct()


def resource_lists(checked: DataFrame) -> DataFrame:
    """Checked rows with the lists that :func:`explode_resources` spreads, made once per sheet row."""
    is_url = F.col("has_url")
    one = F.array(F.lit("*"))
    databases = F.filter(C.csv_array("database"), lambda d: ~C.null_like(d))
    lists = checked.withColumns(
        {"_databases": F.when(is_url, one).otherwise(databases), "_tables": C.csv_array("tables"), "_columns": C.csv_array("columns"), "_labels": C.csv_array("policy_label")}
    )

    def parts(c: str) -> Column:
        return F.when(~is_url & (F.size(c) > 0), F.col(c)).otherwise(one)

    return lists.withColumns({"_tables": parts("_tables"), "_columns": parts("_columns"), "_labels": F.when(F.size("_labels") > 0, F.col("_labels"))})


#: What :func:`explode_resources` reads of rows that have their lists, beside the keys.
LISTED = ("row_index", "role", "item_type", "permissions", "groups", "users", "rowfilter", "url", "has_url", "rejected", "_databases", "_tables", "_columns", "_labels")


def explode_resources(checked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Accepted rows spread over database x table x column (or the url) and role binding."""
    bindings = F.when(
        F.col("role") != "", F.array(F.struct(F.col("role").alias("role"), F.col("users").alias("users")))
    ).otherwise(
        F.transform("users", lambda u: F.struct(F.concat(F.lit("role_"), u).alias("role"), F.array(u).alias("users")))
    )
    is_url = F.col("has_url")
    ok = checked.where(~F.col("rejected"))
    if "_databases" not in checked.columns:
        ok = resource_lists(ok)
    spread = (
        ok.select(*keys, *LISTED).withColumn("binding", F.explode(bindings))
        .select("*", F.posexplode("_databases").alias("p1", "schema_name"))
        .select("*", F.posexplode("_tables").alias("p2", "table_name"))
        .select("*", F.posexplode("_columns").alias("p3", "column_name"))
    )
    table_only = lambda c: F.when(~is_url, F.col(c))
    return spread.select(
        *keys,
        "row_index",
        F.struct("row_index", "p1", "p2", "p3").alias("position"),
        F.when(is_url, F.col("url")).otherwise(A.policy_name("schema_name", "table_name", "column_name")).alias(
            "policy_name"
        ),
        F.when(is_url, "url").otherwise("table").alias("policy_type"),
        table_only("schema_name").alias("schema_name"),
        table_only("table_name").alias("table_name"),
        table_only("column_name").alias("column_name"),
        F.when(is_url, F.col("url")).alias("url"),
        F.col("_labels").alias("labels"),
        F.col("binding.role").alias("role"),
        "item_type",
        "permissions",
        "groups",
        F.col("binding.users").alias("users"),
        "rowfilter",
    )


def policy_headers(exploded: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per policy; the first sheet row that names it fixes its resource and labels."""
    facts = ["policy_type", "schema_name", "table_name", "column_name", "url", "labels"]
    return (
        exploded.groupBy(*keys, "policy_name")
        .agg(F.min(F.struct("position", *facts)).alias("first"))
        .select(*keys, "policy_name", *[F.col("first").getField(c).alias(c) for c in facts])
    )


def policy_members(exploded: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct members of every (policy, role, item_type)."""
    kinds = ("permission", "group", "user", "rowfilter")
    listed = exploded.dropna(subset=["permissions", "groups", "users"])
    rowfilter = F.when(F.col("rowfilter") != "", F.array("rowfilter"))
    lists = F.array("permissions", "groups", "users", rowfilter)
    # lists of a row one after the other, then their values: nothing is built or tagged per value
    by_kind = listed.select(*keys, *ROLE, F.posexplode(lists).alias("_kind", "_values"))
    rows = by_kind.select(*keys, *ROLE, "_kind", F.explode("_values").alias("value"))
    kind = F.get(F.array(*[F.lit(k) for k in kinds]), F.col("_kind"))
    return rows.distinct().select(*keys, *ROLE, kind.alias("kind"), "value")


def _sorted_values(kind: str) -> Column:
    return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("value"))))


def merge_policy_roles(members: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (policy, role, item_type) with sorted permission, group and user lists.

    A role with several row filters is granted nothing: no one of them may be left out.
    """
    filters = _sorted_values("rowfilter")
    return (
        members.groupBy(*keys, *ROLE)
        .agg(
            _sorted_values("permission").alias("permissions"),
            _sorted_values("group").alias("groups"),
            _sorted_values("user").alias("users"),
            filters.alias("_filters"),
        )
        .withColumn("rowfilter_conflict", F.size("_filters") > 1)
        .withColumn("permissions", F.when(~F.col("rowfilter_conflict"), F.col("permissions")).otherwise(F.array().cast("array<string>")))
        .withColumn("rowfilter", F.when(F.size("_filters") == 1, F.get("_filters", F.lit(0))).otherwise(""))
        .drop("_filters")
    )


def rowfilter_conflicts(members: DataFrame, keys: Sequence[str] = KEYS, level: str = "role") -> DataFrame:
    """(policy, role, item_type) or policies that carry more than one distinct row filter."""
    group = [*keys, *(ROLE if level == "role" else ("policy_name",))]
    return (
        members.where(F.col("kind") == "rowfilter")
        .select(*group, "value")
        .distinct()
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("rowfilter_count"))
        .where(F.col("rowfilter_count") > 1)
    )


def conflicting_policies(members: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Policies in which some role has more than one row filter; they are not synchronised."""
    return rowfilter_conflicts(members, keys).select(*keys, "policy_name").distinct()


def member_segments(members: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, policy_name, kind, segment, values): users, groups (roles), permissions and row filters of a policy in segments.

    The form of record for policies with any number of members; :func:`policy_initial_status` has one row per policy.
    """
    roles_of = members.select(*keys, "policy_name", F.lit("role").alias("kind"), F.col("role").alias("value")).where(~C.null_like("value"))
    flat = members.where(F.col("kind") != "group").select(*keys, "policy_name", "kind", "value").unionByName(roles_of)
    return segments(flat, [*keys, "policy_name", "kind"], "value")


def policy_initial_status(members: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """RUNNING row per policy: users, groups (its roles), permissions and the row filter."""
    own = ~C.null_like("role")

    def values(kind: str) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("value"))))

    filters = F.col("_filters")
    return (
        members.where((F.col("kind") != "group") | own)
        .groupBy(*keys, "policy_name")
        .agg(
            values("user").alias("users"),
            F.sort_array(F.collect_set(F.when(own, F.col("role")))).alias("groups"),
            values("permission").alias("permissions"),
            values("rowfilter").alias("_filters"),
        )
        .withColumns(
            {
                "policy_id": F.col("policy_name"),
                "rowfilter": F.when(F.size(filters) == 1, F.get(filters, F.lit(0))),
                "status": F.lit("RUNNING"),
                "error_message": F.lit(""),
            }
        )
        .drop("_filters")
    )


def mapped_members(members: DataFrame, mappings: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Groups and users whose (role, principal, type) is mapped."""
    known = mappings.select(
        *[k for k in keys if k in mappings.columns], "role", F.col("principal").alias("value"), F.col("type").alias("kind")
    ).distinct()
    people = members.where(F.col("kind").isin("group", "user"))
    return people.join(known, known.columns, "left_semi")


def apply_principal_mapping(members: DataFrame, mappings: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Members that survive: mapped principals, plus permissions and filters of roles that kept any."""
    mapped = mapped_members(members, mappings, keys)
    kept = mapped.select(*keys, *ROLE).distinct()
    rest = members.where(~F.col("kind").isin("group", "user")).join(kept, [*keys, *ROLE], "left_semi")
    return mapped.unionByName(rest)


def principal_excluded(members: DataFrame, mappings: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(policy, role, item_type) without any mapped principal; ``policy_failed`` when none is left."""
    kept = mapped_members(members, mappings, keys).select(*keys, *ROLE).distinct()
    alive = kept.select(*keys, "policy_name").distinct().withColumn("_alive", F.lit(True))
    return (
        members.select(*keys, *ROLE)
        .distinct()
        .join(kept, [*keys, *ROLE], "left_anti")
        .join(alive, [*keys, "policy_name"], "left")
        .select(*keys, *ROLE, F.col("_alive").isNull().alias("policy_failed"))
    )


def policy_items(
    members: DataFrame, headers: DataFrame, supported: Sequence[str] | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Access items per policy: one row per (target policy, list, role, access).

    Row filters of allow items become select items of the table-level companion policy. A policy
    with conflicting row filters has no items: without its filter it would grant every row.
    """
    facts = headers.select(*keys, "policy_name", "policy_type", "schema_name", "table_name")
    facts = facts.join(conflicting_policies(members, keys), [*keys, "policy_name"], "left_anti")
    typed = members.where(F.col("kind").isin("permission", "rowfilter") & A.valid_role("role")).join(
        facts, [*keys, "policy_name"]
    )
    is_filter = F.col("kind") == "rowfilter"
    accesses = (
        F.when(is_filter, F.array(F.lit("select")))
        .when(F.col("policy_type") == "url", A.url_access_types(F.col("value")))
        .otherwise(A.access_types(F.col("value")))
    )
    kept = F.when(is_filter, accesses).otherwise(A.supported_access(accesses, supported))
    return (
        typed.where(~is_filter | (F.col("item_type") == "allow"))
        .select(
            *keys,
            "policy_name",
            F.when(is_filter, A.rowfilter_policy_name("schema_name", "table_name"))
            .otherwise(F.col("policy_name"))
            .alias("target_policy"),
            F.when(is_filter, "rowfilter").otherwise(F.col("item_type")).alias("item_list"),
            "role",
            F.explode(kept).alias("access"),
            F.when(is_filter, F.col("value")).alias("filter_expr"),
        )
        .distinct()
    )


def policy_sync_plan(
    headers: DataFrame, items: DataFrame, existing: DataFrame, conflicts: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """created / updated / failed per desired policy.

    A policy needs at least one allow or deny item; otherwise it fails. ``existing`` holds
    (policy_name, policy_id) of the service, ``conflicts`` comes from :func:`conflicting_policies`
    over the members that ``items`` were made from.
    """
    facts = items.groupBy(*keys, "policy_name").agg(
        F.count_if(F.col("item_list").isin("allow", "deny")).alias("_grants"),
        F.max(F.when(F.col("item_list") == "rowfilter", F.col("target_policy"))).alias("rowfilter_policy_name"),
    )
    have = existing.select("policy_name", F.col("policy_id").alias("_id"))
    clash = F.col("_conflict").isNotNull()
    failed = clash | (F.coalesce("_grants", F.lit(0)) == 0)
    return (
        headers.join(facts, [*keys, "policy_name"], "left")
        .join(conflicts.select(*keys, "policy_name", F.lit(True).alias("_conflict")), [*keys, "policy_name"], "left")
        .join(have, "policy_name", "left")
        .select(
            *keys,
            "policy_name",
            "policy_type",
            F.when(failed, "failed").when(F.col("_id").isNotNull(), "updated").otherwise("created").alias("action"),
            F.when(~failed, F.col("_id")).alias("policy_id"),
            F.when(~failed, F.col("rowfilter_policy_name")).alias("rowfilter_policy_name"),
            F.when(clash, "conflicting row filters").when(failed, "no supported access types remain").alias("error"),
        )
    )


def merge_policy_items(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing items with new ones merged in by group.

    ``existing`` is (policy_name, item_list, item_index, groups, users, accesses); ``new`` is
    (policy_name, item_list, group, users, accesses). A group listed twice belongs to its last
    item; a new group opens an item of its own. Users and accesses are unions.
    """
    policy = ["policy_name", "item_list"]
    owner = (
        existing.select(*policy, "item_index", F.explode("groups").alias("group"))
        .groupBy(*policy, "group")
        .agg(F.max("item_index").alias("item_index"))
    )
    placed = new.join(owner, [*policy, "group"], "left").withColumn(
        "new_group", F.when(F.col("item_index").isNull(), F.col("group"))
    )
    added = placed.groupBy(*policy, "item_index", "new_group").agg(
        F.array_distinct(F.flatten(F.collect_set("users"))).alias("add_users"),
        F.array_distinct(F.flatten(F.collect_set("accesses"))).alias("add_accesses"),
    )
    touched = added.where(F.col("item_index").isNotNull()).drop("new_group")
    empty = F.array().cast("array<string>")
    merged = existing.join(touched, [*policy, "item_index"], "left").select(
        *policy,
        "item_index",
        F.sort_array("groups").alias("groups"),
        F.sort_array(F.array_union("users", F.coalesce("add_users", empty))).alias("users"),
        F.sort_array(F.array_union("accesses", F.coalesce("add_accesses", empty))).alias("accesses"),
    )
    opened = added.where(F.col("new_group").isNotNull()).select(
        *policy,
        F.lit(None).cast(existing.schema["item_index"].dataType).alias("item_index"),
        F.array("new_group").alias("groups"),
        F.sort_array("add_users").alias("users"),
        F.sort_array("add_accesses").alias("accesses"),
    )
    return merged.unionByName(opened)


def merge_rowfilter_items(existing: DataFrame, new: DataFrame, updated: DataFrame) -> DataFrame:
    """Row-filter items after a sync.

    By group the users are united while filter and accesses come from the new item. A policy in
    ``updated`` that brings no row filter loses its old ones; other policies are left alone.
    ``existing`` / ``new`` are (policy_name, group, users, accesses, filter_expr), unique per group.
    """
    key = ["policy_name", "group"]
    n = new.select(
        *key,
        F.col("users").alias("n_users"),
        F.col("accesses").alias("n_accesses"),
        F.col("filter_expr").alias("n_filter"),
        F.lit(True).alias("_n"),
    )
    dropped = updated.select("policy_name").distinct().join(new.select("policy_name").distinct(), "policy_name", "left_anti")
    kept = existing.join(dropped, "policy_name", "left_anti")
    empty = F.array().cast("array<string>")
    return kept.join(n, key, "full_outer").select(
        *key,
        F.sort_array(F.array_union(F.coalesce("users", empty), F.coalesce("n_users", empty))).alias("users"),
        F.sort_array(F.when(F.col("_n"), F.col("n_accesses")).otherwise(F.col("accesses"))).alias("accesses"),
        F.when(F.col("_n"), F.col("n_filter")).otherwise(F.col("filter_expr")).alias("filter_expr"),
    )
