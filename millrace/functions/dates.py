"""Date expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")


# Widths of the numeric fields of a date pattern.
_NUMERIC = re.compile(r"yyyy|MM|dd|HH|mm|ss|S+")


def _shape(pattern: str) -> str | None:
    """Regular expression of the texts an all-numeric pattern can read, else None."""
    if re.search("[A-Za-z]", _NUMERIC.sub("", pattern)):
        return None
    parts, end = [], 0
    for field in _NUMERIC.finditer(pattern):
        parts += [re.escape(pattern[end : field.start()]), rf"\d{{{len(field.group())}}}"]
        end = field.end()
    return "^" + "".join(parts) + re.escape(pattern[end:]) + "$"


def _attempt(text: Column, pattern: str) -> Column:
    """Parse only what has the pattern's shape: a failed parse costs an exception."""
    parsed, shape = F.try_to_timestamp(text, F.lit(pattern)), _shape(pattern)
    return F.when(text.rlike(shape), parsed) if shape else parsed


# Texts in ISO order: month and day of one digit, a time, a fraction and a zone may be there.
ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?( ?(Z|UTC|[+-]\d{1,2}(:?\d{2})?))?)?$"


def _iso(text: Column) -> Column:
    zoned = F.regexp_replace(text, r" ?([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(text.rlike(ISO), zoned.try_cast("timestamp"))


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that reads the text gives the timestamp; no format gives null.

    Date-times in ISO order are read besides the default formats, but not besides given ones.
    """
    text = F.trim(c.cast("string"))
    iso = [_iso(text)] if tuple(formats) == DATE_FORMATS else []
    return F.coalesce(*[_attempt(text, f) for f in formats], *iso)
