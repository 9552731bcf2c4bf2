"""Reading loosely typed JSON values held in VARIANT columns.

Every reader distinguishes JSON types before casting, because ``try_variant_get`` happily turns
``true`` into 1 and text into numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TEXT = r"[\s\p{Z}]*[+-]?\d+(?:_\d+)*[\s\p{Z}]*"
FLOAT_TEXT = (
    r"(?i)[\s\p{Z}]*[+-]?(?:(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+)?"
    r"|nan|inf|infinity)[\s\p{Z}]*"
)


def members_of(text: Column, names: Sequence[str]) -> Column:
    """A JSON object's members as a struct of VARIANT fields, read in one pass over the text."""
    return F.from_json(text, ", ".join(f"{n} variant" for n in names))


def texts_of(text: Column, names: Sequence[str]) -> Column:
    """A JSON object's members as a struct of texts, for ``member_columns``."""
    return F.from_json(text, ", ".join(f"{n} string" for n in names))


def member_columns(holder: str, names: Mapping[str, str], texts: str | None = None) -> dict[str, Column]:
    """Kind and text columns of members of a ``members_of`` struct, for ``withColumns``: ``{prefix: member}``.

    ``texts`` names a ``texts_of`` struct of the same members, if there is one. Casting a variant costs more than reading
    the text again, so it gives the text of strings; only other kinds are cast.

    They become columns of their own so that the many conditions on a member read an attribute instead of
    repeating the extraction (repeated extractions outgrow what generated code can hold).
    """
    out = {}
    for prefix, name in names.items():
        value = F.col(f"{holder}.{name}")
        out[f"{prefix}__kind"] = kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        cast = value.cast("string")
        out[f"{prefix}__text"] = cast if texts is None else F.coalesce(F.when(kind == "STRING", F.col(f"{texts}.{name}")), cast)
    return out


class JsonValue:
    """Conditions and conversions on one member added by ``member_columns``."""

    def __init__(self, name: str):
        self.kind, self.text = F.col(f"{name}__kind"), F.col(f"{name}__text")

    def is_null(self) -> Column:
        return self.kind == "VOID"

    def is_string(self) -> Column:
        return self.kind == "STRING"

    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"

    def is_object(self) -> Column:
        return self.kind.startswith("OBJECT")

    def is_nested(self) -> Column:
        return self.is_object() | self.kind.startswith("ARRAY")

    def is_number(self) -> Column:
        return ~(self.is_null() | self.is_string() | self.is_boolean() | self.is_nested())

    def missing(self) -> Column:
        """JSON null, absent, or the empty string: what a required field rejects (0 and false pass)."""
        return self.is_null() | (self.is_string() & (self.text == ""))

    def falsy(self) -> Column:
        """Missing, or a zero, false or empty value."""
        return (
            self.missing()
            | (self.is_boolean() & (self.text == "false"))
            | (self.is_number() & (self.text.try_cast("double") == 0))
            | self.text.isin("{}", "[]") & self.is_nested()
        )

    def as_text(self) -> Column:
        """Text form; booleans print capitalised, nested values as JSON."""
        return F.when(self.is_boolean(), F.initcap(self.text)).when(~self.is_null(), self.text)

    def scalar_text(self) -> Column:
        """Text of a scalar; NULL for objects and arrays, which a text column cannot take."""
        return F.when(~self.is_null() & ~self.is_nested(), self.text)

    def as_double(self) -> Column:
        """The number, or numeric text, as double; NULL when it is neither."""
        digits = F.regexp_replace(self.text, r"[_\s\p{Z}]", "")
        return F.when(self.is_number(), self.text.try_cast("double")).when(
            self.is_string() & self.text.rlike(rf"\A(?:{FLOAT_TEXT})\z"), digits.try_cast("double")
        )

    def as_integer(self) -> Column:
        """The integer as double so that any magnitude can be range-checked; fractions are cut off."""
        digits = F.regexp_replace(self.text, r"[_\s\p{Z}]", "")
        number = self.text.try_cast("double")
        finite = F.abs(number) < F.lit(float("inf"))
        cut = F.when(number < 0, -F.floor(-number)).otherwise(F.floor(number)).cast("double")
        return F.when(self.is_number() & finite, cut).when(
            self.is_string() & self.text.rlike(rf"\A(?:{INTEGER_TEXT})\z"), digits.try_cast("double")
        )
