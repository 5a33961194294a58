"""Policy lineage: which policies stand behind each role, group and mapping of a run.

``policies`` is (run_id, policy_name, policy_id, status, groups, users[, rowfilter_policy_name]);
``objects`` is (run_id, object_type, object_name, policy_name, policy_id, ...).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import access as A
from lakeshift.operators.principals import ACCESS_GROUP, IDENTITY_GROUP, MAPPING, POLICY, ROLE
from lakeshift.operators.windows import segments


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def effective_policies(policies: DataFrame) -> DataFrame:
    """Policies that were created or updated and have a name and an id."""
    return policies.where(F.col("status").isin("CREATED", "UPDATED") & ~_blank("policy_name") & ~_blank("policy_id"))


def policy_object_names(policies: DataFrame) -> DataFrame:
    """Object names of each effective policy: its own and its row-filter companion's."""
    good = effective_policies(policies)
    companion = F.concat(F.col("policy_name"), F.lit(A.ROWFILTER_SUFFIX))
    if "rowfilter_policy_name" in policies.columns:
        companion = F.coalesce("rowfilter_policy_name", companion)
    return good.select(
        "run_id", F.explode(F.array(F.col("policy_name"), companion)).alias("object_name"), "policy_name", "policy_id"
    )


def principal_links(policies: DataFrame) -> DataFrame:
    """Distinct (run, principal, policy): the flat form of the lineage, whatever its size."""
    return (
        effective_policies(policies)
        .select("run_id", F.explode(F.concat("groups", "users")).alias("principal"), "policy_name", "policy_id")
        .where(~_blank("principal"))
        .distinct()
    )


def joined_names(links: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct policy names and ids per key, sorted and joined by a comma.

    Names and ids are made distinct per key by their own aggregates first, so a principal that
    occurs in millions of rows reaches its task as a short list.
    """
    values = (
        links.select(
            *keys,
            F.inline(
                F.array(
                    F.struct(F.lit("policy_name").alias("_c"), F.col("policy_name").alias("_v")),
                    F.struct(F.lit("policy_id").alias("_c"), F.col("policy_id").alias("_v")),
                )
            ),
        )
        .where(F.col("_v").isNotNull())
        .distinct()
    )
    return values.groupBy(*keys).agg(
        *[
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("_c") == c, F.col("_v")))), ", ").alias(c)
            for c in ("policy_name", "policy_id")
        ]
    )


def principal_policies(policies: DataFrame) -> DataFrame:
    return joined_names(principal_links(policies), ["run_id", "principal"])


def label_policies(objects: DataFrame, kind: str) -> DataFrame:
    """Policies per role (``kind='role'``) or per group (``kind='group'``), read off mapping labels."""
    return joined_names(label_links(objects, kind), ["run_id", "name"])


def policy_segments(links: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, segment, values): distinct policy names per key in segments, for keys with any number of policies."""
    return segments(links, keys, "policy_name")


def label_links(objects: DataFrame, kind: str) -> DataFrame:
    """(run_id, name, policy_name, policy_id) of roles or groups, read off mapping labels."""
    name = A.label_role("object_name") if kind == "role" else A.label_group("object_name")
    mapped = objects.where((F.col("object_type") == MAPPING) & (F.coalesce("policy_name", F.lit("")) != ""))
    return mapped.select("run_id", name.alias("name"), "policy_name", "policy_id").where(F.coalesce("name", F.lit("")) != "")


def _open() -> Column:
    return (F.coalesce("policy_id", F.lit("")) == "") | (F.coalesce("policy_name", F.lit("")) == "")


def backfill(objects: DataFrame, source: DataFrame, types: list[str], key: Column | None = None) -> DataFrame:
    """Fill policy name and id on open objects of ``types``.

    ``source`` is (run_id, name, policy_name, policy_id), unique per (run_id, name); ``key`` says
    what of the object must equal ``name`` (default: the object name). Objects of other types have no
    key and find nothing; the hash of their names spreads them over the tasks of the join.
    """
    key = F.col("object_name") if key is None else key
    s = source.select(
        "run_id",
        F.col("name").alias("_key"),
        F.xxhash64("name").alias("_spread"),
        F.col("policy_name").alias("_policy_name"),
        F.col("policy_id").alias("_policy_id"),
    )
    target = objects.withColumn("_key", F.when(F.col("object_type").isin(types), key))
    target = target.withColumn("_spread", F.xxhash64(F.coalesce("_key", "object_name")))
    fill = _open() & F.col("_policy_name").isNotNull()
    return target.join(s, ["run_id", "_key", "_spread"], "left").select(
        *[
            F.when(fill, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("policy_name", "policy_id") else F.col(c)
            for c in objects.columns
        ]
    )


def _policy_source(policies: DataFrame) -> DataFrame:
    """Companions may be shared by column policies of one table; the first policy name stands for it."""
    return (
        policy_object_names(policies)
        .groupBy("run_id", F.col("object_name").alias("name"))
        .agg(F.min(F.struct("policy_name", "policy_id")).alias("p"))
        .select("run_id", "name", "p.policy_name", "p.policy_id")
    )


def _principal_source(policies: DataFrame) -> DataFrame:
    return principal_policies(policies).withColumnRenamed("principal", "name")


def backfill_policy_objects(objects: DataFrame, policies: DataFrame) -> DataFrame:
    return backfill(objects, _policy_source(policies), [POLICY])


def backfill_groups(objects: DataFrame, policies: DataFrame) -> DataFrame:
    return backfill(objects, _principal_source(policies), [ACCESS_GROUP, IDENTITY_GROUP])


def backfill_mappings(objects: DataFrame, policies: DataFrame) -> DataFrame:
    return backfill(objects, _principal_source(policies), [MAPPING], A.label_principal("object_name"))


def backfill_roles(objects: DataFrame) -> DataFrame:
    return backfill(objects, label_policies(objects, "role"), [ROLE])


def backfill_role_groups(objects: DataFrame) -> DataFrame:
    """Access groups take over what is known of the role of the same name."""
    source = objects.where((F.col("object_type") == ROLE) & (F.coalesce("policy_name", F.lit("")) != "")).select(
        "run_id", F.col("object_name").alias("name"), "policy_name", "policy_id"
    )
    return backfill(objects, source, [ACCESS_GROUP])


def backfill_identity_groups(objects: DataFrame) -> DataFrame:
    return backfill(objects, label_policies(objects, "group"), [IDENTITY_GROUP])


def backfill_all(objects: DataFrame, policies: DataFrame) -> DataFrame:
    """The whole chain (policy, group, mapping, role, access group, identity group) in one join.

    Each object type is filled from at most two sources in a fixed order, and only mappings and
    roles feed later steps. So the sources are derived from those two slices, stacked with their
    type and order, reduced to the first per object and joined once, instead of rewriting the
    ledger six times.
    """
    principals = _principal_source(policies)
    mappings = backfill(
        objects.where(F.col("object_type") == MAPPING), principals, [MAPPING], A.label_principal("object_name")
    )
    role_source = label_policies(mappings, "role")
    roles = backfill(objects.where(F.col("object_type") == ROLE), role_source, [ROLE])
    role_names = roles.where(F.coalesce("policy_name", F.lit("")) != "").select(
        "run_id", F.col("object_name").alias("name"), "policy_name", "policy_id"
    )

    def tagged(source: DataFrame, object_type: str, step: int) -> DataFrame:
        return source.select(
            "run_id", F.lit(object_type).alias("object_type"), "name", F.lit(step).alias("step"), "policy_name", "policy_id"
        )

    sources = reduce(
        DataFrame.unionByName,
        [
            tagged(_policy_source(policies), POLICY, 1),
            tagged(principals, ACCESS_GROUP, 2),
            tagged(principals, IDENTITY_GROUP, 2),
            tagged(principals, MAPPING, 3),
            tagged(role_source, ROLE, 4),
            tagged(role_names, ACCESS_GROUP, 5),
            tagged(label_policies(mappings, "group"), IDENTITY_GROUP, 6),
        ],
    )
    first = (
        sources.groupBy("run_id", "object_type", F.col("name").alias("_key"))
        .agg(F.min(F.struct("step", "policy_name", "policy_id")).alias("_s"))
        .select(
            "run_id", "object_type", "_key", F.col("_s.policy_name").alias("_policy_name"), F.col("_s.policy_id").alias("_policy_id")
        )
    )
    key = F.when(F.col("object_type") == MAPPING, A.label_principal("object_name")).otherwise(F.col("object_name"))
    fill = _open() & F.col("_policy_name").isNotNull()
    return (
        objects.withColumn("_key", key)
        .join(first, ["run_id", "object_type", "_key"], "left")
        .select(
            *[
                F.when(fill, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("policy_name", "policy_id") else F.col(c)
                for c in objects.columns
            ]
        )
    )


def policy_final_status(
    initial: DataFrame, objects: DataFrame, applied: DataFrame, excluded: DataFrame, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Policy rows at the end of a run.

    Status and message come from the policy's own object row (a companion's only when there is no
    other, since one companion serves all column policies of a table), the id from the own row too
    (the name when there is none). Groups are the roles that were applied. ``applied`` /
    ``excluded`` are (policy_name, role).
    """
    by = [*keys, "policy_name"]
    rows = objects.where(F.col("object_type") == POLICY)
    own = ~F.col("object_name").endswith(A.ROWFILTER_SUFFIX)
    latest = rows.groupBy(*keys, A.base_policy("object_name").alias("policy_name")).agg(
        F.max(F.struct(own.alias("own"), "sequence", "status", "error_message")).alias("_o"),
        F.max(F.when(own, F.struct("sequence", F.coalesce("policy_id", F.lit("")).alias("policy_id")))).alias("_i"),
    )

    def names(df: DataFrame, alias: str) -> DataFrame:
        return df.select(*by, "role").distinct().groupBy(*by).agg(F.sort_array(F.collect_list("role")).alias(alias))

    status = F.coalesce(F.col("_o.status"), F.lit("RUNNING"))
    message = F.coalesce(F.col("_o.error_message"), F.lit(""))
    note = F.when(
        F.col("_excluded").isNotNull() & (status != "FAILED"),
        F.concat(F.lit("excluded roles without a mapped principal: "), F.array_join("_excluded", ", ")),
    )
    joined = (
        initial.join(latest, by, "left").join(names(applied, "_applied"), by, "left").join(names(excluded, "_excluded"), by, "left")
    )
    replaced = {
        "policy_id": F.coalesce(F.col("_i.policy_id"), F.col("policy_name")),
        "groups": F.coalesce("_applied", "groups"),
        "status": status,
        "error_message": F.concat_ws(" | ", F.nullif(message, F.lit("")), note),
    }
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in initial.columns])
