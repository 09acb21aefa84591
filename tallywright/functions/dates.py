"""Date and timestamp text, parsed without raising under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date and timestamp formats the jobs accept, first match wins.
SALES_DATE_FORMATS = ("dd-MM-yyyy", "M/d/yyyy", "MM/dd/yyyy")
ISO_DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm")


def _has_marks_of(text: Column, fmt: str) -> Column:
    """True when ``text`` holds every separator of ``fmt``.

    A failed parse throws inside the JVM, once per row and format. This check
    leaves out the formats which cannot match, so mixed columns stay cheap.
    """
    marks = sorted({c for c in fmt if not c.isalnum()})
    fits = F.lit(True)
    for mark in marks:
        fits = fits & text.contains(mark)
    return fits


def parse_date(text: Column, fmt: str) -> Column:
    """Date by one format; null where the text does not match."""
    return F.when(_has_marks_of(text, fmt), F.try_to_date(text, fmt))


def repair_date(text: Column, formats: Sequence[str] = SALES_DATE_FORMATS) -> Column:
    """Date by the first of ``formats`` that matches, else null.

    A format of two-digit parts is not tried after the same one of shorter parts, which
    reads all that it reads.
    """
    tried: list[str] = []
    for fmt in formats:
        if fmt.replace("MM", "M").replace("dd", "d") not in tried:
            tried.append(fmt)
    return F.coalesce(*[parse_date(text, fmt) for fmt in tried])


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp by the first of ``formats`` that matches, else null."""
    return F.coalesce(
        *[F.when(_has_marks_of(text, fmt), F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats]
    )
