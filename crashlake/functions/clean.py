"""Cleaning expressions for the wide feed.

All built-in functions: no Python UDF, so each expression compiles into the
scan's whole-stage code.  ANSI casts raise on bad input, hence try_cast /
try_to_timestamp throughout.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from crashlake.schema import COORD_PRECISION, COORD_SCALE, NA_TOKENS

# Leading/trailing whitespace as Python's str.strip() sees it: Unicode white
# space plus the ASCII separators U+001C..U+001F.  Spark's trim() only removes
# spaces.
_EDGE_WS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# Accepted spellings, tried in order; the first that parses wins.
DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss",
                "yyyy-MM-dd HH:mm:ss")
TIME_FORMATS = ("H:mm", "H:mm:ss", "h:mm a", "h:mm:ss a")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: Column | str) -> Column:
    """The CSV reader's NA spellings become NULL (exact match)."""
    c = _c(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip_ws(c: Column | str) -> Column:
    """Without white space at both ends.  Blanks go without a pattern, which is
    run only where another sign than plain ASCII is left at an end."""
    t = F.trim(_c(c))
    plain = F.substring(t, 1, 1).between("!", "~") & F.substring(t, -1, 1).between("!", "~")
    return F.when(plain, t).otherwise(F.regexp_replace(t, _EDGE_WS, ""))


def stripped_or_null(c: Column | str) -> Column:
    """Trimmed text; NULL when nothing is left."""
    s = strip_ws(c)
    return F.when(s != "", s)


def number_text(c: Column | str) -> Column:
    """The text if it is a plain decimal number, else NULL: a cast alone would
    also take the JVM's suffixed and hexadecimal forms ('12d', '0x1p3')."""
    c = _c(c)
    return F.when(c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), c)


def _whole(c: Column | str) -> Column:
    """The text if it begins and ends with a digit and has no point, else NULL: where
    that is a whole number to a cast, ``number_text`` need not be asked."""
    c = _c(c)
    return F.when(F.substring(c, 1, 1).between("0", "9") & F.substring(c, -1, 1).between("0", "9") & ~c.contains("."), c)


def parse_id(c: Column | str) -> Column:
    """Integer ids; decimals are truncated ('12.0' -> 12, '3.7' -> 3),
    anything non-numeric is NULL.  The exact integer parse is tried first so
    ids above 2^53 keep every digit."""
    n = number_text(c)
    return F.coalesce(_whole(c).try_cast("bigint"), n.try_cast("bigint"), n.try_cast("double").try_cast("bigint"))


def _tried(c: Column, formats) -> Column:
    """The first format that parses.  A failed parse costs an exception, so a
    format is tried only on text with as many slashes, colons and letters as
    it writes itself.  Without letters, that is what is left of the text when
    digits and the format's other signs are taken away."""
    def like(f: str) -> Column:
        written = re.sub("'T'", "T", f)
        marks = "".join(m for m in written if m in "/:T-")
        if " a" in f:
            return c.rlike("[A-Za-z]$") & (F.regexp_replace(c, "[^/:T-]", "") == marks)
        other = {m for m in written if not m.isalnum()} - set("/:T-")
        return F.translate(c, "".join(sorted(other | set("0123456789+"))), "") == marks

    return F.coalesce(*[F.when(like(f), F.try_to_timestamp(c, F.lit(f))) for f in formats])


def parse_date(c: Column | str, formats=DATE_FORMATS) -> Column:
    """Calendar date; unparsable text (or an impossible date) is NULL."""
    return _tried(_c(c), formats).cast("date")


def parse_time(c: Column | str, formats=TIME_FORMATS) -> Column:
    """C4: time of day as zero-padded HH:mm:ss text (sorts like a TIME)."""
    return F.date_format(_tried(_c(c), formats), "HH:mm:ss")


def parse_coordinate(c: Column | str) -> Column:
    """numeric(9,6); out-of-range or non-numeric text is NULL (and is
    reported by ``invalid``)."""
    return number_text(c).try_cast(f"decimal({COORD_PRECISION},{COORD_SCALE})")


def parse_count(c: Column | str) -> Column:
    """Integer count; '2.0' -> 2, halves round away from zero as the
    database does when a decimal meets an integer column."""
    return F.coalesce(_whole(c).try_cast("int"), F.round(number_text(c).try_cast("double")).try_cast("int"))


def parse_zip(c: Column | str) -> Column:
    """Zip as text; a float rendering such as '11201.0' loses the '.0'."""
    c = _c(c)
    return F.when(c.contains(".0"), F.regexp_replace(c, r"^(\d+)\.0+$", "$1")).otherwise(c)


def invalid(raw: Column, parsed: Column) -> Column:
    """True when a value was present but did not survive parsing."""
    return raw.isNotNull() & parsed.isNull()
