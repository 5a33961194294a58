"""Policy run: sheet -> compiled policies -> sync plan -> status rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from lakeshift.operators import policy, principals
from lakeshift.operators.windows import DEFAULT_BLOCK_ROWS
from lakeshift.sources.scratch import stored


@dataclass(frozen=True)
class CompiledSheet:
    """Compiled policies of one or more sheets.

    ``members`` and ``headers`` both spread the stored rows of the sheet and their lists, each only with the columns that
    it needs, and are stored themselves, so all of it runs once however many plans are made from them.
    """

    exploded: DataFrame
    keys: Sequence[str]

    @cached_property
    def members(self) -> DataFrame:
        return stored(policy.policy_members(self.exploded, self.keys), "policy_members")

    @cached_property
    def headers(self) -> DataFrame:
        return stored(policy.policy_headers(self.exploded, self.keys), "policy_headers")


def compile_sheet(
    sheet: DataFrame, keys: Sequence[str] = policy.KEYS, order: str = "row_index", block_rows: int = DEFAULT_BLOCK_ROWS
) -> CompiledSheet:
    # stored: a filter on what the checks found would be pushed below them, and compute each cell again for every use
    checked = policy.resource_lists(policy.check_rows(policy.fill_context(sheet, keys, order, block_rows)))
    return CompiledSheet(policy.explode_resources(stored(checked.select(*keys, *policy.LISTED), "policy_checked"), keys), keys)


def sync_plan(
    compiled: CompiledSheet, mappings: DataFrame, existing: DataFrame, supported: Sequence[str] | None = None
) -> DataFrame:
    """What a sync would create, update or fail, with principals that could not be mapped left out."""
    applied = policy.apply_principal_mapping(compiled.members, mappings, compiled.keys)
    items = policy.policy_items(applied, compiled.headers, supported, compiled.keys)
    conflicts = policy.conflicting_policies(applied, compiled.keys)
    return policy.policy_sync_plan(compiled.headers, items, existing, conflicts, compiled.keys)


def object_statuses(plan: DataFrame, identity: DataFrame, run_id: str) -> DataFrame:
    """Status rows of the policies and identities of one run."""
    from pyspark.sql import functions as F

    return principals.combine_status(
        principals.policy_status_rows(plan).withColumn("run_id", F.lit(run_id)), principals.status_rows(identity, run_id)
    )
