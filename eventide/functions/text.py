"""Stored-value normalisation and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ISO_SECONDS_PATTERN, RAW_COLUMNS


def flatten_whitespace(c: Column) -> Column:
    """Tab and newline become a space (null stays null)."""
    return F.translate(c, "\t\n", "  ")


def seconds(ts: Column) -> Column:
    """Timestamp cut to whole seconds, as the store keeps it."""
    return F.date_trunc("second", ts)


def iso_seconds(ts: Column) -> Column:
    """ISO text of a whole-second timestamp (window bounds)."""
    return F.date_format(ts, ISO_SECONDS_PATTERN)


def store_projection(events: DataFrame, *others: Column) -> DataFrame:
    """The 9 stored columns in order, timestamps cut to seconds and text
    flattened to one line; then ``others``."""
    out = []
    types = {f.name: f.dataType for f in events.schema.fields}
    for name in RAW_COLUMNS:
        c = F.col(name)
        if isinstance(types[name], (T.TimestampType, T.TimestampNTZType)):
            c = seconds(c)
        elif isinstance(types[name], T.StringType):
            c = flatten_whitespace(c)
        out.append(c.alias(name))
    return events.select(*out, *others)
