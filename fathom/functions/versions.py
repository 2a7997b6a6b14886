"""The version planner: one CASE over (current, changed, base, proposed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGHEST = 999


def plan_version(current: Column, changed: Column, base: Column, proposed: Column) -> Column:
    """Struct (outcome, code, expected). Versions outside 1..999 are INVALID_VERSION."""
    outside = F.lit(False)
    for v in (current, base, proposed):
        outside = outside | F.coalesce(~v.between(1, HIGHEST), F.lit(False))
    expected = (F.when(current.isNull(), 1).when(~changed, current)
                .when(current < HIGHEST, current + 1))
    stale = F.when(current.isNull(), base.isNotNull()).otherwise(~base.eqNullSafe(current))
    as_planned = proposed.isNull() | proposed.eqNullSafe(expected)
    code = (F.when(outside, "INVALID_VERSION")
            .when(stale, "VERSION_STALE")
            .when(current.isNull(), F.when(as_planned, "NEW_V1").otherwise("VERSION_GAP"))
            .when(~changed, F.when(as_planned, "NO_CHANGE").otherwise("VERSION_NO_CHANGE"))
            .when(expected.isNull(), "VERSION_LIMIT_REACHED")
            .when(as_planned, "ADVANCE")
            .when(proposed <= current, "VERSION_COLLISION")
            .otherwise("VERSION_GAP"))
    allowed = code.isin("NEW_V1", "NO_CHANGE", "ADVANCE")
    return F.struct(F.when(allowed, "ALLOW").otherwise("BLOCK").alias("outcome"), code.alias("code"),
                    F.when(code != "INVALID_VERSION", expected).cast("int").alias("expected"))
