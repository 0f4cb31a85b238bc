"""Sort keys that ascend from the preferred value to the least preferred one, NULL last, as SQL text.

A group's best row is then ``min(struct(keys..., payload...))``: an aggregate that Spark combines before the
shuffle, so one huge group sends one row per map task instead of all its rows to one task.

Text rather than Column objects: wide expressions cross from Python to the JVM once instead of once per node.
"""

from __future__ import annotations


def literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def latest_ts_first(ts: str) -> str:
    return f"{ts} IS NULL, TIMESTAMP_NTZ'1970-01-01 00:00:00' - {ts}"


def latest_date_first(date: str) -> str:
    return f"{date} IS NULL, -datediff({date}, DATE'1970-01-01')"


def true_first(flag: str) -> str:
    return f"CASE WHEN {flag} THEN 0 WHEN NOT {flag} THEN 1 ELSE 2 END"
