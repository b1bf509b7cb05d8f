"""Text and code standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Accented lower-case letters and their plain forms, letter by letter.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Strip all Unicode white space from both ends (`trim` strips blanks only)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def lower_trimmed(c: Column | str) -> Column:
    return F.lower(trimmed(c))


def upper_trimmed(c: Column | str) -> Column:
    return F.upper(trimmed(c))


def folded(c: Column | str, lower_first: bool = True) -> Column:
    """Trimmed lower-case text without diacritics.

    With `lower_first=False` only lower-case accents are folded before lowering, so
    an upper-case accented letter keeps its accent.
    """
    text = trimmed(c)
    if lower_first:
        return F.translate(F.lower(text), ACCENTED, PLAIN)
    return F.lower(F.translate(text, ACCENTED, PLAIN))


def has_accent(c: Column | str) -> Column:
    return col(c).rlike(f"[{ACCENTED}]")


def padded_code(c: Column | str, width: int = 5) -> Column:
    """A numeric code as text of fixed width with leading zeros."""
    return F.lpad(col(c).cast("string"), width, "0")


def malformed_code(c: Column | str, width: int = 5) -> Column:
    return (F.char_length(col(c)) != width) | ~col(c).rlike(f"^[0-9]{{{width}}}$")
