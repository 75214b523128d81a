"""Batch stamps."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def stamp_batch(
    tables: Mapping[str, DataFrame], batch_id: str | None = None, as_of: datetime.datetime | None = None
) -> dict[str, DataFrame]:
    """Add one ``batch_id`` for all tables and the ``ingestion_time``; both can be fixed for a repeatable run."""
    stamp = {
        "batch_id": F.lit(batch_id or str(uuid.uuid4())),
        "ingestion_time": F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp(),
    }
    return {name: df.withColumns(stamp) for name, df in tables.items()}
