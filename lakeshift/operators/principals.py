"""Identity sync plans and the status rows they leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import access as A

# Object types of the object-status ledger.
ROLE, IDENTITY_GROUP, ACCESS_GROUP, MAPPING, POLICY = "role", "keycloak_group", "ranger_group", "mapping", "policy"


def _present(df: DataFrame, columns: list[str], flag: str) -> DataFrame:
    return df.select(*columns).distinct().withColumn(flag, F.lit(True))


def principal_sync_plan(
    roles: DataFrame,
    principals: DataFrame,
    have_roles: DataFrame,
    have_groups: DataFrame,
    have_users: DataFrame,
    have_mappings: DataFrame,
) -> DataFrame:
    """Status of every role, group and mapping a sync would touch.

    Roles and mappings are CREATED or ALREADY_EXISTS; a group the identity service lacks is FAILED
    and fails its mappings, as does an unknown user. Snapshot tables replace the service calls.
    """
    role_rows = (
        roles.select("role")
        .distinct()
        .join(_present(have_roles, ["role"], "_have"), "role", "left")
        .select(
            F.lit(ROLE).alias("object_type"),
            F.col("role").alias("object_name"),
            _created("_have").alias("status"),
            F.lit("").alias("error_message"),
        )
    )
    wanted = principals.select("role", "principal", "type").distinct()
    known_people = (
        have_groups.select(F.col("group").alias("principal"), F.lit("group").alias("type"))
        .unionByName(have_users.select(F.col("user").alias("principal"), F.lit("user").alias("type")))
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    missing = F.concat(F.col("type"), F.lit(" '"), F.col("principal"), F.lit("' does not exist"))
    checked = wanted.join(known_people, ["principal", "type"], "left")
    group_rows = (
        checked.where(F.col("type") == "group")
        .select("principal", "type", "_known")
        .distinct()
        .select(
            F.lit(IDENTITY_GROUP).alias("object_type"),
            F.col("principal").alias("object_name"),
            F.when(F.col("_known"), "ALREADY_EXISTS").otherwise("FAILED").alias("status"),
            F.when(F.col("_known"), "").otherwise(missing).alias("error_message"),
        )
    )
    mapping_rows = checked.join(
        _present(have_mappings, ["role", "principal", "type"], "_have"), ["role", "principal", "type"], "left"
    ).select(
        F.lit(MAPPING).alias("object_type"),
        A.mapping_label("role", "principal", "type").alias("object_name"),
        F.when(F.col("_known").isNull(), "FAILED").otherwise(_created("_have")).alias("status"),
        F.when(F.col("_known").isNull(), missing).otherwise("").alias("error_message"),
    )
    return role_rows.unionByName(group_rows).unionByName(mapping_rows)


def _created(flag: str) -> Column:
    return F.when(F.col(flag).isNull(), "CREATED").otherwise("ALREADY_EXISTS")


def status_rows(plan: DataFrame, run_id: str, attempt: int = 1) -> DataFrame:
    """Plan rows as ledger rows of one run."""
    return plan.select(
        F.lit(run_id).alias("run_id"), "object_type", "object_name", "status", "error_message", F.lit(attempt).alias("attempt")
    )


def all_failed_rows(roles: DataFrame, principals: DataFrame, run_id: str, reason: str, attempt: int = 1) -> DataFrame:
    """Status rows when the identity service was unreachable: everything FAILED."""
    objects = (
        roles.select(F.lit(ROLE).alias("object_type"), F.col("role").alias("object_name"))
        .unionByName(
            principals.where(F.col("type") == "group").select(
                F.lit(IDENTITY_GROUP).alias("object_type"), F.col("principal").alias("object_name")
            )
        )
        .unionByName(
            principals.select(
                F.lit(MAPPING).alias("object_type"), A.mapping_label("role", "principal", "type").alias("object_name")
            )
        )
        .distinct()
    )
    return objects.select(
        F.lit(run_id).alias("run_id"),
        "object_type",
        "object_name",
        F.lit("FAILED").alias("status"),
        F.lit(f"identity service connection failed: {reason}").alias("error_message"),
        F.lit(attempt).alias("attempt"),
    )


def access_group_rows(roles: DataFrame, have_groups: DataFrame) -> DataFrame:
    """Access-service groups, one per role: CREATED or ALREADY_EXISTS."""
    have = have_groups.select(F.col("group").alias("role")).distinct().withColumn("_have", F.lit(True))
    return (
        roles.where(A.valid_role("role"))
        .select("role")
        .distinct()
        .join(have, "role", "left")
        .select(
            F.lit(ACCESS_GROUP).alias("object_type"),
            F.col("role").alias("object_name"),
            _created("_have").alias("status"),
            F.lit("").alias("error_message"),
        )
    )


def policy_status_rows(plan: DataFrame) -> DataFrame:
    """Status rows of a policy sync: the policy and, where there is one, its row-filter companion."""
    ok = F.col("action") != "failed"
    base = F.struct(F.col("policy_name").alias("object_name"), F.lit(0).alias("sequence"))
    companion = F.struct(F.col("rowfilter_policy_name").alias("object_name"), F.lit(1).alias("sequence"))
    both = F.filter(
        F.array(base, companion), lambda x: (x["sequence"] == 0) | (ok & x["object_name"].isNotNull())
    )
    return plan.select("*", F.inline(both)).select(
        *[c for c in plan.columns if c not in {"policy_name", "policy_type", "action", "policy_id", "rowfilter_policy_name", "error"}],
        F.lit(POLICY).alias("object_type"),
        "object_name",
        F.when(ok, F.coalesce(F.col("policy_id").cast("string"), F.lit(""))).alias("policy_id"),
        F.when(ok, F.col("policy_name")).alias("policy_name"),
        F.upper("action").alias("status"),
        F.coalesce("error", F.lit("")).alias("error_message"),
        "sequence",
    )


def combine_status(*parts: DataFrame) -> DataFrame:
    """Status rows of several sources under one schema."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def object_type_counts(objects: DataFrame) -> DataFrame:
    return objects.groupBy("object_type").agg(F.count(F.lit(1)).alias("object_count"))


def policy_run_metrics(objects: DataFrame) -> DataFrame:
    """Counts per run, kind and state, and COMPLETED / PARTIAL_FAILURE."""
    kind, status = F.col("object_type"), F.col("status")

    def n(k: str, s: str) -> Column:
        return F.count_if((kind == k) & (status == s))

    # the companion of a policy is logged as an object of its own but is not another policy
    base = ~F.col("object_name").endswith(A.ROWFILTER_SUFFIX)
    policies = lambda s: F.count_if((kind == POLICY) & (status == s) & base)
    return (
        objects.groupBy("run_id")
        .agg(
            n(ACCESS_GROUP, "CREATED").alias("groups_created"),
            n(ACCESS_GROUP, "ALREADY_EXISTS").alias("groups_existing"),
            policies("CREATED").alias("policies_created"),
            policies("UPDATED").alias("policies_updated"),
            policies("FAILED").alias("policies_failed"),
            n(ROLE, "CREATED").alias("roles_created"),
            n(ROLE, "ALREADY_EXISTS").alias("roles_existing"),
            n(MAPPING, "CREATED").alias("mappings_created"),
            n(MAPPING, "ALREADY_EXISTS").alias("mappings_existing"),
            F.count(F.lit(1)).alias("total_objects"),
            F.count_if(status.isin("CREATED", "UPDATED", "ALREADY_EXISTS")).alias("successful_objects"),
            F.count_if(status == "FAILED").alias("failed_objects"),
        )
        .withColumn(
            "overall_status", F.when(F.col("failed_objects") == 0, "COMPLETED").otherwise("PARTIAL_FAILURE")
        )
    )
