"""Instants as columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(at, kind: T.DataType | None = None) -> Column:
    """``at`` as a column of type ``kind``, a time stamp unless given.

    A datetime without a zone is read in the session's time zone, whatever the
    driver's is; text likewise. Columns and other values are cast.
    """
    if isinstance(at, datetime) and at.tzinfo is None:
        at = at.isoformat(sep=" ")
    return (at if isinstance(at, Column) else F.lit(at)).cast(kind or T.TimestampType())
