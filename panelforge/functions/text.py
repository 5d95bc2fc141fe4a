"""Text folding and tests, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Latin letters with marks and the letters below them, by canonical decomposition."""
    marked, plain = [], []
    for code in range(0xC0, 0x1F00):
        parts = unicodedata.normalize("NFKD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and parts[0].isalpha() and all(unicodedata.combining(x) for x in parts[1:]):
            marked.append(chr(code))
            plain.append(parts[0])
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accents()
#: Presentation forms of two or three letters.
_LIGATURES = {chr(c): unicodedata.normalize("NFKD", chr(c)) for c in range(0xFB00, 0xFB07)}


def strip_marks(c: Column) -> Column:
    """Letters without their accents, combining marks and ligatures; ASCII texts pass at once."""
    plain = c
    for form, letters in _LIGATURES.items():
        plain = F.replace(plain, F.lit(form), F.lit(letters))
    plain = F.regexp_replace(F.translate(plain, _MARKED, _PLAIN), "[\\u0300-\\u036f]", "")
    return F.when(c.rlike("^[\\x00-\\x7f]*$"), c).otherwise(plain)


def fold_header(c: Column) -> Column:
    """A header as it is compared: no marks, lower case, runs of other signs as one space."""
    return F.trim(F.regexp_replace(F.lower(strip_marks(c)), "[^a-z0-9]+", " "))


def fold_header_text(text: str) -> str:
    """fold_header() for the driver's own tables."""
    plain = "".join(x for x in unicodedata.normalize("NFKD", text) if not unicodedata.combining(x)).lower()
    return " ".join("".join(x if x.isascii() and x.isalnum() else " " for x in plain).split())


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def standard_name(c: Column) -> Column:
    """Upper-case name of letters, apostrophes and hyphens; blank is null."""
    kept = F.regexp_replace(strip_marks(c), "[^A-Za-z\\s'-]", "")
    return F.nullif(F.upper(collapse(kept)), F.lit(""))


def first_letter(c: Column) -> Column:
    return F.nullif(F.left(F.upper(F.trim(c)), F.lit(1)), F.lit(""))


def blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | c.rlike("^\\s*$")


def present(c: Column) -> Column:
    return ~blank(c)


def digits(c: Column) -> Column:
    """The digits of a text; none is null."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def twelve_digits(c: Column) -> Column:
    return F.coalesce(F.trim(c).rlike("^[0-9]{12}$"), F.lit(False))


def cell_text(number: Column) -> Column:
    """A numeric cell as text: whole numbers without a fraction, NaN and infinities empty."""
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(odd, "").when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))


def lookup(c: Column, values: dict[str, str]) -> Column:
    """Values replaced by a case-insensitive dictionary; others stay as they are."""
    pairs = [F.lit(x) for k, v in values.items() for x in (k.strip().casefold(), v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.trim(c))), c)
