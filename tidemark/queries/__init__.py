"""Every registered query, each with the SQL it must agree with."""

from __future__ import annotations

from tidemark.queries import catalogs, conversions, history, increments, ingest, merges, outputs
from tidemark.queries.common import Check

CHECKS: dict[str, Check] = {
    **increments.CHECKS,
    **conversions.CHECKS,
    **outputs.CHECKS,
    **merges.CHECKS,
    **ingest.CHECKS,
    **history.CHECKS,
    **catalogs.CHECKS,
}
