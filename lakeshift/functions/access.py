"""Access-policy helpers: permissions, policy names, item types and mapping labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshift.functions.cells import bound, col, csv_array, null_like, strip

# Access types that the three named permissions stand for.
READ_ACCESS = ["select", "use", "execute", "show", "read_sysinfo"]
WRITE_ACCESS = [
    "select", "insert", "update", "delete", "create", "drop", "alter", "use", "show", "grant",
    "revoke", "execute", "read", "write", "read_sysinfo", "write_sysinfo",
]
ALL_ACCESS = [
    "select", "insert", "update", "delete", "create", "drop", "alter", "use", "show", "grant",
    "revoke", "impersonate", "execute", "read", "write", "read_sysinfo", "write_sysinfo",
]
# Permissions on a URL that mean read, or read and write.
URL_READ = ["read", "select"]
URL_WRITE = ["write", "insert", "update", "delete", "all"]
# Item types; anything else is read as the first.
ITEM_TYPES = ["allow", "allow_exception", "deny", "deny_exception"]
ROWFILTER_SUFFIX = "__rowfilter"
DEFAULT_CATALOG = "iceberg"
# Fixed format of a mapping label: role->principal (type)
LABEL_PRINCIPAL = r"->([^(]+)\s*\((group|user)\)$"
LABEL_GROUP = r"->([^(]+)\s*\(group\)$"
LABEL_ROLE = r"^(.+?)->"


def _words(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def permission_array(c: Column | str) -> Column:
    """Lower-cased permission list, ``['read']`` when none is given; unknown words stay."""
    parts = F.transform(csv_array(c), F.lower)
    return bound(parts, lambda found: F.when(F.size(found) == 0, _words(["read"])).otherwise(found))


def access_types(permission: Column) -> Column:
    p = F.lower(strip(permission))
    return (
        F.when(p == "read", _words(READ_ACCESS))
        .when(p == "write", _words(WRITE_ACCESS))
        .when(p == "all", _words(ALL_ACCESS))
        .otherwise(F.array(p))
    )


def url_access_types(permission: Column) -> Column:
    p = F.lower(strip(permission))
    return (
        F.when(p.isin(URL_READ), _words(["read"]))
        .when(p.isin(URL_WRITE), _words(["read", "write"]))
        .otherwise(F.array(p))
    )


def expand_permissions(c: Column | str) -> Column:
    return F.array_distinct(F.flatten(F.transform(col(c), access_types)))


def expand_url_permissions(c: Column | str) -> Column:
    return F.array_distinct(F.flatten(F.transform(col(c), url_access_types)))


def supported_access(c: Column | str, supported: Sequence[str] | None) -> Column:
    """Access types the service knows; ``None`` means it accepts all."""
    known = F.filter(F.transform(col(c), lambda a: F.lower(strip(a))), lambda a: a != "")
    return F.array_distinct(known) if supported is None else F.array_intersect(known, _words(supported))


def dropped_access(c: Column | str, supported: Sequence[str] | None) -> Column:
    known = F.filter(F.transform(col(c), lambda a: F.lower(strip(a))), lambda a: a != "")
    return F.array().cast("array<string>") if supported is None else F.array_except(known, _words(supported))


def rowfilter_valid(c: Column | str) -> Column:
    """A row filter may hold no statement end and no line break."""
    return ~F.coalesce(col(c).rlike(r"[;\n\r]"), F.lit(False))


def item_type(c: Column | str) -> Column:
    v = F.lower(strip(c))
    return F.when(v.isin(ITEM_TYPES), v).otherwise(ITEM_TYPES[0])


def valid_role(c: Column | str) -> Column:
    return ~null_like(c)


def _named(c: Column) -> Column:
    """The part itself unless it is empty or a wildcard (then null, which concat_ws skips)."""
    return F.when((c != "") & (c != "*"), c)


def policy_name(database, table, column, catalog: str = DEFAULT_CATALOG) -> Column:
    database, table, column = col(database), col(table), col(column)
    t, c = _named(table), _named(column)
    return F.when(database == "*", F.lit(catalog)).otherwise(
        F.concat_ws(
            ".", F.lit(catalog), database, F.when(c.isNotNull(), F.coalesce(t, F.lit("*"))).otherwise(t), c
        )
    )


def rowfilter_policy_name(schema, table, catalog: str = DEFAULT_CATALOG) -> Column:
    """Companion row-filter policy; always at table level."""
    return F.concat(
        F.concat_ws(".", _named(F.lit(catalog)), _named(col(schema)), _named(col(table))),
        F.lit(ROWFILTER_SUFFIX),
    )


def base_policy(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"{ROWFILTER_SUFFIX}$", "")


def mapping_label(role, principal, kind) -> Column:
    return F.concat(col(role), F.lit("->"), col(principal), F.lit(" ("), col(kind), F.lit(")"))


def label_principal(c: Column | str) -> Column:
    return F.trim(F.regexp_extract(col(c), LABEL_PRINCIPAL, 1))


def label_role(c: Column | str) -> Column:
    return F.trim(F.regexp_extract(col(c), LABEL_ROLE, 1))


def label_group(c: Column | str) -> Column:
    """Principal of a group mapping, null for any other label."""
    c = col(c)
    return F.when(c.rlike(LABEL_GROUP), F.trim(F.regexp_extract(c, LABEL_GROUP, 1)))


def label_list(c: Column | str) -> Column:
    """Policy labels of a cell; null when there are none."""
    return bound(csv_array(c), lambda parts: F.when(F.size(parts) > 0, parts))
