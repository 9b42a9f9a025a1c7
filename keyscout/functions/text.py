"""Blank handling and normalisation of values.

Source values are compared as strings. NULL, the empty string and a run of spaces are the
same "blank" value; trailing spaces never matter unless a function says so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str | Column) -> Column:
    """A column by its literal name, whatever characters the name has."""
    return name if isinstance(name, Column) else F.col("`" + name.replace("`", "``") + "`")


def as_text(c: str | Column) -> Column:
    """NULL to blank, otherwise untouched."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def normalize(c: str | Column) -> Column:
    """NULL to blank and trailing spaces removed."""
    return F.rtrim(as_text(c))


def not_blank(c: str | Column) -> Column:
    """True for values with content; NULL and blanks give false or NULL, so filters drop them."""
    return F.rtrim(col(c).cast("string")) != F.lit("")


# Types whose values can be counted as they are, and the type to count them in. Other types are counted as text.
_COUNTED_AS = {
    T.ByteType: "bigint",
    T.ShortType: "bigint",
    T.IntegerType: "bigint",
    T.LongType: "bigint",
    T.DoubleType: "double",
    T.DateType: "date",
    T.TimestampType: "timestamp_ntz",  # two instants may have one text where clocks are put back
}


def counted_as(kind: T.DataType) -> str:
    """A type in which values of type ``kind`` are equal exactly if their texts are, ``is_minus_zero`` aside."""
    return _COUNTED_AS.get(type(kind), "string")


def is_minus_zero(c: Column) -> Column:
    """Whether a double is the zero that has a text of its own; a grouping takes both zeros as one."""
    return F.when(c == 0, c.cast("string").startswith("-")).otherwise(F.lit(False))


def without_table_prefix(c: str | Column) -> Column:
    """``schema.table`` to ``table``: drop everything up to the first dot."""
    return F.regexp_replace(col(c), r"^[^.]*\.", "")


# Signs that separate names in node ids, merged nodes and FD texts, and the escape itself.
SEPARATORS = "%|/,:[]\n"


def escaped(c: str | Column) -> Column:
    """A name in which every separator is written as ``%`` and two hexadecimal digits; other names are unchanged."""
    out = col(c)
    for sign in SEPARATORS:
        out = F.replace(out, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return out


def unescaped(c: str | Column) -> Column:
    """The name behind ``escaped``."""
    out = col(c)
    for sign in reversed(SEPARATORS):
        out = F.replace(out, F.lit(f"%{ord(sign):02X}"), F.lit(sign))
    return out


def node_id(sys_code, table_code, col_code) -> Column:
    """Graph node id of a field: escaped system, table and column joined by a pipe."""
    return F.concat_ws("|", escaped(sys_code), escaped(table_code), escaped(col_code))


def node_text(*parts: str) -> str:
    """``node_id`` of names that are known."""
    return "|".join("".join(f"%{ord(x):02X}" if x in SEPARATORS else x for x in part) for part in parts)


def node_part(node: str | Column, place: int) -> Column:
    """System (0), table (1) or column (2) of a node id."""
    return unescaped(F.get(F.split(node, r"\|"), place))
