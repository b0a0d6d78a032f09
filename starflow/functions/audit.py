"""Audit columns stamped by every load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_time(at: datetime | None = None) -> Column:
    """The load's timestamp: ``at`` when given (repeatable runs), else now."""
    return F.current_timestamp() if at is None else F.lit(at)


def audit_columns(at: datetime | None = None) -> list[Column]:
    stamp = load_time(at)
    return [stamp.alias("etl_insert_time"), stamp.alias("etl_update_time")]
