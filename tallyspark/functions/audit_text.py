"""Text forms used by the audit rows: run timestamps and a repeatable row hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the audit timestamps are 24-hour clock text followed by an AM/PM
# mark, e.g. "2024-02-01 17:03:04 PM".
AUDIT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss a"


def audit_ts_text(ts: Column) -> Column:
    """Timestamp as audit text."""
    return F.date_format(ts, AUDIT_TS_FORMAT)


def row_hash(*cols: Column) -> Column:
    """SHA-256 hex of the fields joined by ``|``; NULL fields count as empty text.

    Unlike a per-process salted hash this is the same on every run and engine,
    so a re-run can be recognised by its hash.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)
