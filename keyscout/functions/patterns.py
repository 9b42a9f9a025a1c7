"""Recognisers for the textual form of values: dates, times, numbers, Chinese text.

The patterns use only syntax shared by Java and RE2 regular expressions. They are written
without anchors; ``full_match`` adds them. ``\\z`` is used because Java's ``$`` also matches
before a trailing newline.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: what counts as a date ------------------------------------------------
YEAR = "([0-9]{3}[1-9]|[0-9]{2}[1-9][0-9]|[0-9][1-9][0-9]{2}|[1-9][0-9]{3})"
LEAP_YEAR = "([0-9]{2}(0[48]|[2468][048]|[13579][26])|(0[48]|[2468][048]|[3579][26])00)"


def _month_day(zero: str, separator: str) -> str:
    """Month and day of a common year; ``zero`` is the (optional) leading zero."""
    months_31 = f"({zero}[13578]|1[02])"
    months_30 = f"({zero}[469]|11)"
    days_28 = f"({zero}[1-9]|1[0-9]|2[0-8])"
    days_30 = f"({zero}[1-9]|[12][0-9]|30)"
    days_31 = f"({zero}[1-9]|[12][0-9]|3[01])"
    return (
        f"({months_31}{separator}{days_31}"
        f"|{months_30}{separator}{days_30}"
        f"|{zero}2{separator}{days_28})"
    )


DATE = "|".join(
    [f"{YEAR}{s}{_month_day('0?', s)}" for s in ("-", "/", "[.]")]
    + [f"{YEAR}{_month_day('0', '')}"]
    + [f"{LEAP_YEAR}[-/.]0?2[-/.]29", f"{LEAP_YEAR}0229"]
)

# ---- fixed values: times and numbers ----------------------------------------------------
TIME = "([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?"
FRACTION = "[.]([0-9]{3}|[0-9]{6})"
INTEGER = "[-+]?([1-9][0-9]*|0)"
FLOAT = (
    "[-+]?[0-9]*[.][0-9]*"                      # plain decimal; also '.' alone
    "|[-+]?[0-9]*[.][0-9]+[Ee][-+]?[0-9]+"      # scientific
    "|[-+]?[1-9][0-9]{0,2}(,[0-9]{3})*[.][0-9]+"  # thousands separated
)
NUMBER = "[-+]?([0-9]+[.][0-9]*|[1-9][0-9]*|0)"
DIGITS = "[-+]?[0-9]+"
CHINESE = "[一-龥]"

# ---- fixed values: column names that never hold codes ------------------------------------
CODE_NAME_EXCLUSIONS = "year|month|day|time|date|flag|flg|remark"


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"^({pattern})\\z")


def is_date(c: Column) -> Column:
    return full_match(c, DATE)


def is_time(c: Column) -> Column:
    return full_match(c, TIME)


def is_fraction(c: Column) -> Column:
    return full_match(c, FRACTION)


def is_integer(c: Column) -> Column:
    return full_match(c, INTEGER)


def is_float(c: Column) -> Column:
    return full_match(c, FLOAT)


def is_number(c: Column) -> Column:
    return full_match(c, NUMBER)


def has_chinese(c: Column) -> Column:
    return c.rlike(CHINESE)


def is_timestamp(c: Column) -> Column:
    """Date and time in one value, after ``/`` to ``-`` and without spaces.

    The length decides the layout: 14 compact, 18 with separators, 22 and 25 with
    milliseconds and microseconds.
    """
    s = F.replace(F.replace(c, F.lit("/"), F.lit("-")), F.lit(" "), F.lit(""))
    size = F.length(s)
    compact_time = F.concat_ws(":", s.substr(9, 2), s.substr(11, 2), s.substr(13, 2))
    compact = is_date(s.substr(1, 8)) & is_time(compact_time)
    dashed = (s.substr(5, 1) == "-") & (s.substr(8, 1) == "-")
    spaced = dashed & is_date(s.substr(1, 10)) & is_time(s.substr(11, 8)) & (s.substr(16, 1) == ":")
    return (
        F.when(size == 14, compact)
        .when(size == 18, spaced)
        .when(size.isin(22, 25), spaced & is_fraction(s.substr(19, 7)))
        .otherwise(F.lit(False))
    )


# Bits of the value marks.
DATE_BIT, TIME_BIT, TIMESTAMP_BIT, FLOAT_BIT, INTEGER_BIT, CHINESE_BIT = 1, 2, 4, 8, 16, 32


def value_marks(c: Column) -> Column:
    """All recognisers of one value as an integer bit set.

    Guards on length, signs and bytes skip the expensive patterns for values that cannot match.
    """
    size, point = F.length(c), c.contains(".")
    dated = c.substr(5, 1).isin("-", "/", ".") | ((size == 8) & ~point)

    def bit(condition: Column, value: int) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(0))

    return (
        bit(size.between(8, 10) & dated & is_date(c), DATE_BIT)
        + bit(size.isin(5, 8) & (c.substr(3, 1) == ":") & is_time(c), TIME_BIT)
        + bit((size >= 14) & c.rlike("^ *[0-9]") & is_timestamp(c), TIMESTAMP_BIT)
        + bit(point & is_float(c), FLOAT_BIT)
        + bit(~point & is_integer(c), INTEGER_BIT)
        + bit((F.octet_length(c) > size) & has_chinese(c), CHINESE_BIT)
    )


def integer_marks(c: Column) -> Column:
    """``value_marks`` of the text of a typed integer, or of a blank."""
    size = F.length(c)
    month = c.substr(5, 2).between("01", "12")
    return (
        F.when(size == 0, 0)
        .when((size == 8) & month & is_date(c), INTEGER_BIT + DATE_BIT)
        .when((size == 14) & month & is_timestamp(c), INTEGER_BIT + TIMESTAMP_BIT)
        .otherwise(INTEGER_BIT)
    )


def has_mark(marks: Column, value: int) -> Column:
    return marks.bitwiseAND(F.lit(value)) != 0


def type_vote(marks: Column) -> Column:
    """The single class a value votes for."""
    return (
        F.when(has_mark(marks, DATE_BIT), "date")
        .when(has_mark(marks, TIME_BIT), "time")
        .when(has_mark(marks, TIMESTAMP_BIT), "timestamp")
        .when(has_mark(marks, FLOAT_BIT), "float")
        .when(has_mark(marks, INTEGER_BIT), "integer")
        .otherwise("character")
    )


# Fixed value: order in which equal vote counts win.
VOTE_ORDER = ("integer", "float", "date", "time", "timestamp", "character")


def to_double(c: Column) -> Column:
    """The number in a decimal text, thousands separators removed; NULL if there is none."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")
