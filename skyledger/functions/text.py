"""Defensive text clean-up (FN-15, FN-16)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the feeds' producers treat as blank. Spark's own
# trim removes the plain space only.
ASCII_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
BLANKS = ASCII_BLANKS + (
    "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spark's cast takes a number with the suffix of a Java literal; the feeds' producers do not. No number has these
# letters but the words for infinity.
_SUFFIXES = "dDfF"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def strip(text: Column) -> Column:
    """Text without blanks at its ends. Nearly all of it is plain ASCII, for
    which a third of the characters need to be looked for."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_BLANKS))).otherwise(F.btrim(text, F.lit(BLANKS)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def number(text: Column) -> Column:
    """PRJ-6: a double, or null for anything that is not one; never an error. The text is evaluated once where it is a
    finite number, which nearly all of it is."""
    plain = F.translate(text, _SUFFIXES, "x" * len(_SUFFIXES)).try_cast("double")
    return F.coalesce(plain, F.when(text.rlike(_INFINITE), text).try_cast("double"))


def truthy(text: Column) -> Column:
    """PRJ-8: whether a JSON scalar, held as text, counts as true."""
    value = number(text)
    return F.coalesce(F.when(value.isNotNull(), value != 0).otherwise(~text.isin("", "false")), F.lit(False))
