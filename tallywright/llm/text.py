"""Column expressions over whole texts; ASCII rules, independent of any locale."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# All characters beyond ASCII that have a lower-case form are in these categories, or
# in none yet where the pattern's tables are older than those of ``lower``.
_OTHER_UPPER = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^A-Z]]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. ``lower`` does it where no other letter
    would change; ``translate``, which goes letter by letter, does the rest."""
    return F.when(text.rlike(_OTHER_UPPER), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def trim(text: Column) -> Column:
    """Without ASCII white space at both ends."""
    return F.trim(text, F.lit(SPACE))


def words(text: Column) -> Column:
    """The runs without ASCII white space; none of a null."""
    inner = trim(F.coalesce(text, F.lit("")))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def lines(text: Column) -> Column:
    """The text cut at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
