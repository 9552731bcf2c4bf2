"""Text helpers whose edge cases differ between Spark's defaults and the warehouse semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters with the Unicode White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column | str) -> Column:
    """Trim every Unicode white space, not only U+0020 as ``trim`` does by default (no regex involved)."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def strip_column(name: str) -> Column:
    """``strip`` of a column of texts that mostly have nothing to trim: those that begin and end visibly in ASCII stay as they are."""
    text = F.col(name)
    plain = F.substring(text, 1, 1).between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(plain, text).otherwise(strip(text))


def blank(c: Column | str) -> Column:
    """NULL or empty."""
    return col(c).isNull() | (col(c) == "")


def full_match(c: Column | str, pattern: str) -> Column:
    """Whole-string regex match; ``$`` alone would also accept a trailing newline."""
    return col(c).rlike(rf"\A(?:{pattern})\z")


def joined_key(*parts: Column | str, sep: str = "|") -> Column:
    """Concatenate with a separator; a NULL part makes the key NULL, so coalesce where that is unwanted."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(col(part))
    return F.concat(*pieces)


def row_json(*columns: str) -> Column:
    """A row as JSON text that keeps NULL fields (``to_json`` drops them by default)."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def frame_row_json(df: DataFrame) -> Column:
    return row_json(*df.columns)


def spaced_json(c: Column) -> Column:
    """Compact JSON text re-spaced to ``{"a": 1, "b": 2}``; separators inside strings are left alone."""
    return F.regexp_replace(c, r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:]++)*+)([,:])', "$1$2 ")


def sorted_map_json(c: Column | str) -> Column:
    """A string map as JSON text with sorted keys; an absent map prints ``{}``."""
    entries = F.array_sort(F.map_entries(F.coalesce(col(c), F.create_map().cast("map<string,string>"))))
    return spaced_json(F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}))
