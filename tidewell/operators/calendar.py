"""Calendar text in the format of RFC 5545."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CRLF = "\r\n"


def escape(c: Column) -> Column:
    """Backslash first, then semicolon, comma and line feed."""
    for plain, marked in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        c = F.replace(c, F.lit(plain), F.lit(marked))
    return c


def stable_uid(name: Column, number: Column | None = None) -> Column:
    """From the catalogue number where there is one, else from the name."""
    hashed = F.concat(F.lit("h"), F.substring(F.md5(name.cast("binary")), 1, 12))
    return hashed if number is None else F.coalesce(F.concat(F.lit("moe"), number.cast("string")), hashed)


def event(uid: Column, start: Column, summary: Column, *more: Column) -> Column:
    """An event of every year; further lines that are null are left out."""
    lines = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), uid), F.concat(F.lit("DTSTART;VALUE=DATE:"), start), F.lit("RRULE:FREQ=YEARLY"), F.concat(F.lit("SUMMARY:"), escape(summary)), *more, F.lit("END:VEVENT")]
    return F.array_join(F.array_compact(F.array(*lines)), CRLF)


def calendar(events: Column, product: str, name: str) -> Column:
    """A whole calendar from an array of events."""
    head = CRLF.join(["BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:{product}", f"X-WR-CALNAME:{name}"])
    return F.concat(F.lit(head + CRLF), F.array_join(events, CRLF), F.lit(CRLF + "END:VCALENDAR" + CRLF))
