"""Text -> typed values with the rules of Spark's pre-ANSI ``CAST`` and the
LEGACY ``to_date(col, 'yyyy-MM-dd')`` parser, written as plain column
expressions so the result does not depend on session flags
(``spark.sql.ansi.enabled``, ``spark.sql.legacy.timeParserPolicy``).

All three functions stay JVM-side (regex, ``try_cast``, string builders), so
they fuse into whole-stage code generation with the surrounding projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions._util import to_col

# Fixed values (old integral cast rules): leading/trailing characters with a
# code point <= 0x20 are stripped; a decimal number keeps its integer part;
# a lone "." (optionally signed) and an empty integer part read as 0.
_EDGE_WS = r"^[\x00-\x20]+|[\x00-\x20]+$"
_DECIMAL_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d*)$"
_SIGNED_INT_PART = r"^([+-]?\d*)"
_INT_DIGITS = r"^[+-]?(\d*)"

# Fixed value (LEGACY yyyy-MM-dd parse): a year, month and day made of digits,
# separated by "-", with blanks allowed after each "-"; text after the day is
# ignored.
DATE_PREFIX = r"^(\d+)-\s*(\d+)-\s*(\d+)"


def int_by_rule(c) -> Column:
    """The old integral cast rule, regex route only (see ``legacy_int``)."""
    s = F.regexp_replace(to_col(c), _EDGE_WS, "")
    digits = F.regexp_extract(s, _INT_DIGITS, 1)
    whole = F.regexp_extract(s, _SIGNED_INT_PART, 1)
    return F.when(
        s.rlike(_DECIMAL_TEXT),
        F.when(digits == "", F.lit(0)).otherwise(whole.try_cast("int")),
    )


def legacy_int(c) -> Column:
    """String -> int like the non-ANSI cast: ``' 12 '``->12, ``'12.7'``->12,
    ``'-0.9'``->0, ``'.'``->0; ``'1e3'``, ``'abc'``, overflow -> NULL."""
    c = to_col(c)
    # Fast path: plain integer text (what the rule accepts unchanged) needs
    # no regex; the rule only runs when the plain cast fails.
    return F.coalesce(c.try_cast("int"), int_by_rule(c))


def legacy_double(c) -> Column:
    """String -> double; unparseable text gives NULL (``NaN``/``Infinity`` kept)."""
    return to_col(c).try_cast("double")


def date_by_rule(c) -> Column:
    """The LEGACY ``yyyy-MM-dd`` parse, regex route only (see ``legacy_date``)."""
    c = to_col(c)
    year = F.regexp_extract(c, DATE_PREFIX, 1)
    month = F.regexp_extract(c, DATE_PREFIX, 2).try_cast("int")
    day = F.regexp_extract(c, DATE_PREFIX, 3).try_cast("int")
    year4 = F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year)
    text = F.concat(year4, F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string"))
    return F.when(c.rlike(DATE_PREFIX), text.try_cast("date"))


def legacy_date(c) -> Column:
    """``to_date(c, 'yyyy-MM-dd')`` with the LEGACY parser: the date prefix is
    read, one- to many-digit month/day fields are accepted, impossible dates
    (``2024-02-30``, month 13) give NULL."""
    c = to_col(c)
    # Fast path without regex for the common exact shape dddd-dd-dd, where
    # the rule reduces to a plain date cast.
    exact_shape = (
        (F.length(c) == 10)
        & (F.substring(c, 5, 1) == "-")
        & (F.substring(c, 8, 1) == "-")
        & (F.translate(c, "0123456789", "") == "--")
    )
    return F.when(exact_shape, c.try_cast("date")).otherwise(date_by_rule(c))


def zero_if_missing(c, zero=0) -> Column:
    """``DataFrame.fillna`` semantics for one column: NULL -> ``zero``, and for
    floating columns NaN -> ``zero`` as well."""
    c = to_col(c)
    if isinstance(zero, float):
        return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(zero))
    return F.coalesce(c, F.lit(zero))
