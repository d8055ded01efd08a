"""Wall-clock timestamp literals, independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(x: dt.datetime) -> Column:
    """A timestamp_ntz literal. A Python datetime passed to ``lit`` becomes a
    zoned TIMESTAMP first, which a session outside UTC would shift; a string
    cast to timestamp_ntz keeps the wall-clock value exactly."""
    return F.lit(x.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
