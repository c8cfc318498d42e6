"""Micro-batch helpers shared by the batch and the streaming forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.operators.windows import US, floor_to, from_micros, to_micros


def batch_start(ts: Column | str, batch_s: int) -> Column:
    """Start of the trigger interval a row arrives in (batch form of a
    micro-batch id: rows are replayed in event-time order)."""
    return from_micros(floor_to(to_micros(ts), batch_s * US))
