"""Decoding coded columns against a long code table ``(table, column, code) -> label``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode_columns(
    facts: DataFrame,
    codes: DataFrame,
    table: str,
    outputs: Mapping[str, tuple[str, str]],
    names: tuple[str, str, str, str] = ("id_tabela", "nome_coluna", "chave", "valor"),
) -> DataFrame:
    """Left-join one label column per entry of ``outputs``: ``{label column: (fact column, code column)}``.

    The facts must already hold trimmed codes. Whether a slice of the code table is broadcast is left to
    Spark's byte threshold; otherwise it is a shuffle join whose hot codes adaptive execution splits.
    """
    t, c, k, v = names
    slices = codes.filter(F.col(t) == table)
    out = facts
    for label, (fact_column, code_column) in outputs.items():
        dim = slices.filter(F.col(c) == code_column).select(
            F.col(k).alias(f"__{label}"), F.col(v).alias(label)
        )
        out = out.join(dim, F.col(fact_column) == F.col(f"__{label}"), "left").drop(f"__{label}")
    return out


def grouped_label(label: Column | str, groups: Mapping[str, str], prefixes: Mapping[str, str] | None = None) -> Column:
    """Map labels to group names, then by prefix; anything else keeps its own name."""
    subject = F.col(label) if isinstance(label, str) else label
    out = None
    for group in dict.fromkeys(groups.values()):
        members = [m for m, g in groups.items() if g == group]
        hit = subject.isin(members)
        out = F.when(hit, group) if out is None else out.when(hit, group)
    for prefix, group in (prefixes or {}).items():
        hit = subject.startswith(prefix)
        out = F.when(hit, group) if out is None else out.when(hit, group)
    return subject if out is None else out.otherwise(subject)
