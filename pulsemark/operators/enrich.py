"""Column jobs: time keys of an event table, fields of a key=value column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, text


def time_keys(rows: DataFrame, ts: str, reference: str) -> DataFrame:
    """Add date, hour and minute keys of ``ts``, and how it lies to the text time ``reference``."""
    shown = calendar.format_time(F.col(ts))
    pivot = F.lit(reference)
    return rows.withColumns({
        "time_text": shown,
        "date_text": calendar.format_date(F.col(ts)),
        "day_before": calendar.yesterday_text(F.col(ts)),
        "date_key": calendar.date_key(F.col(ts)),
        "hour_key": calendar.date_hour(shown),
        "minute_key": calendar.minute_key(F.col(ts)),
        "is_before": calendar.before(shown, pivot),
        "is_after": calendar.after(shown, pivot),
        "seconds_to": calendar.seconds_between(shown, pivot),
    })


def kv_fields(rows: DataFrame, column: str, delimiter: str, fields: list[str],
              updates: dict[str, str] | None = None) -> DataFrame:
    """Read ``fields`` of a ``k=v`` column into columns, and write ``updates`` into it.

    The rewritten text goes to ``<column>_updated``.
    """
    read = {name: text.get_field(F.col(column), delimiter, name) for name in fields}
    rewritten = F.col(column)
    for name, value in (updates or {}).items():
        rewritten = text.set_field(rewritten, delimiter, name, value)
    if updates:
        read[f"{column}_updated"] = rewritten
    return rows.withColumns(read)
