"""Version numbers, ids that carry them, and request addresses, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The grammar of versions and of tool ids, and what a change makes move on.
_NUMBER, _NAME, _BUILD = "0|[1-9][0-9]*", "[0-9]*[A-Za-z-][0-9A-Za-z-]*", "[0-9A-Za-z-]+"
_SEMVER = rf"^({_NUMBER})\.({_NUMBER})\.({_NUMBER})(?:-((?:{_NUMBER}|{_NAME})(?:\.(?:{_NUMBER}|{_NAME}))*))?(?:\+({_BUILD}(?:\.{_BUILD})*))?\z"


_TOOL_ID = r"^[a-z][a-z0-9_]*\.[a-z][a-z0-9_]*\.v([1-9][0-9]*)$"
CHANGES = {
    "schema_required_field_changed": "schema_version",
    "schema_field_type_changed": "schema_version",
    "messages_incompatible": "schema_version",
    "tool_call_incompatible": "schema_version",
    "tool_added": "tool_registry_version",
    "tool_removed": "tool_registry_version",
    "tool_input_changed": "tool_registry_version",
    "tool_output_changed": "tool_registry_version",
    "tool_required_parameters_changed": "tool_registry_version",
    "tool_execution_environment_changed": "tool_registry_version",
    "tool_schema_incompatible": "tool_id_major",
    "description_only": "patch_only",
}


def parsed(version: Column) -> Column:
    """major, minor, patch, prerelease and build of a version; null for what is none. Structs compare field by field."""
    part = lambda i: F.regexp_extract(version, _SEMVER, i)
    number = lambda i, name: F.nullif(part(i), F.lit("")).try_cast("long").alias(name)
    return F.when(version.rlike(_SEMVER), F.struct(number(1, "major"), number(2, "minor"), number(3, "patch"), F.nullif(part(4), F.lit("")).alias("prerelease"), F.nullif(part(5), F.lit("")).alias("build")))


def in_development(version: Column) -> Column:
    return F.coalesce(parsed(version)["major"] == 0, F.lit(False))


def major_matches(tool_id: Column, version: Column) -> Column:
    """Whether a tool id's `.vN` is its version's major number; false for what is no tool id or no version."""
    return F.coalesce(tool_major(tool_id) == parsed(version)["major"], F.lit(False))


def tool_major(tool_id: Column) -> Column:
    return F.nullif(F.regexp_extract(tool_id, _TOOL_ID, 1), F.lit("")).try_cast("long")


def change_target(change: Column) -> Column:
    """Which version a change makes move on; null for an unknown change."""
    return F.create_map(*(F.lit(x) for kv in CHANGES.items() for x in kv))[change]


def next_number(ids: Column, code: str, kind: str = "tctr") -> Column:
    """An aggregate: one more than the largest number among ids of a code; 1 without any."""
    own = F.nullif(F.regexp_extract(ids, f"^{kind}_{code}_([0-9]{{6}})$", 1), F.lit("")).cast("int")
    return F.coalesce(F.max(own), F.lit(0)) + 1


def address(base: Column, host: list[str], arguments: dict[str, Column]) -> Column:
    """A request address: https, an allowed host, no user or fragment, arguments by name; null where base breaks a rule."""
    fine = base.rlike(r"^https://[^@#?]+$") & F.parse_url(base, F.lit("HOST")).isin(*host)
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string"))) for k, v in sorted(arguments.items())]
    return F.when(fine, F.concat(base, F.lit("?"), F.concat_ws("&", *pairs)) if pairs else base)


def redacted(secret: Column) -> Column:
    return F.when(secret.isNotNull(), F.lit("<configured>"))


def backoff(attempt: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    """Seconds before a retry, without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))


def first_failure(checks: dict[str, Column], passed: str = "passed") -> Column:
    """The name of the first check, in order, that doesn't hold; a null doesn't."""
    return reduce(lambda rest, kv: F.when(~F.coalesce(kv[1], F.lit(False)), F.lit(kv[0])).otherwise(rest), reversed(checks.items()), F.lit(passed))
