"""One NULL model for every operator: blank text and the NA words are NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NA vocabulary of the record model.
NA_WORDS = ("nan", "none", "null", "n/a", "na", "#n/a", "-")


# White space as Unicode and Python define it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Trim white space of any kind. Looks at the ends only, unlike a pattern."""
    return F.btrim(c, F.lit(SPACES))


def clean_str(c: Column) -> Column:
    """Trimmed text, or NULL for blank text and the NA words in any case."""
    t = strip(c)
    return F.when((t != "") & ~F.lower(t).isin(*NA_WORDS), t)


def present(c: Column) -> Column:
    """True where clean_str keeps a value; never NULL."""
    return clean_str(c).isNotNull()


def is_missing(c: Column) -> Column:
    return clean_str(c).isNull()


def safe_str(c: Column, default: str = "") -> Column:
    return F.coalesce(clean_str(c), F.lit(default))


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(r"(?U)^\s*$"), c)
