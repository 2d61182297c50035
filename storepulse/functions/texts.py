"""Ids, ISO timestamps and bracketed log lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Id formats.
CUSTOMER_ID = "CLI-%06d"
PRODUCT_ID = "PROD-%06d"
SALE_ID = "TRX-%08d"
CAMPAIGN_ID = "CMP-%05d"
EVENT_ID = "EVT-%06d"

# Fixed value: timestamps in messages are ISO text to the second.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

LOG_FIELDS = ("logged_at", "level", "store", "event", "detail")


def padded_id(pattern: str, number: Column) -> Column:
    return F.format_string(pattern, number)


def iso_seconds(moment: Column) -> Column:
    return F.date_format(moment, ISO_SECONDS)


def moment(text: Column) -> Column:
    """Text to timestamp; unreadable text gives NULL instead of failing the job."""
    return F.try_to_timestamp(text)


def log_line(logged_at: Column, level: Column, store: Column, event: Column,
             detail: Column) -> Column:
    """``[timestamp] [level] [store] [event] [detail]``"""
    stamp = F.date_format(logged_at, "yyyy-MM-dd HH:mm:ss")
    return F.format_string("[%s] [%s] [%s] [%s] [%s]", stamp, level, store, event, detail)


def parse_log_line(line: Column) -> Column:
    """Struct of the five fields; all NULL when the line is not of that shape.

    One split per line. The limit keeps any further brackets inside the detail.
    """
    inner = F.substring(line, F.lit(2), F.length(line) - 2)
    parts = F.split(inner, r"\] \[", 5)
    well_formed = line.startswith("[") & line.endswith("]") & (F.size(parts) == 5)
    fields = [F.when(well_formed, F.get(parts, F.lit(i))) for i in range(5)]
    fields[0] = moment(fields[0])
    return F.struct(*[field.alias(name) for field, name in zip(fields, LOG_FIELDS)])
