"""Declarative row rules: tag, split into clean rows and quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import row_json

CRITICAL, ALERT = "critical_rules", "alert_rules"

# Fixed output values.
VALID_STATUS = "VALID"
ALERT_STATUS = "ALERT"
SEVERITY = "CRITICAL"
MESSAGE_PREFIX = "Registro rejeitado pelas regras: "


@dataclass(frozen=True)
class Rule:
    """A named condition describing a *violation*. A NULL condition means the rule is not violated."""

    id: str
    broken: Column

    def __post_init__(self) -> None:
        if "," in self.id or not self.id:
            raise ValueError(f"rule ids must be non-empty and free of commas: {self.id!r}")


def broken_ids(rules: Sequence[Rule]) -> Column:
    """Ids of the violated rules in declaration order, as one generated-code expression.

    ``concat_ws`` skips the NULLs of unbroken rules; ``array_compact`` would do the same through an
    interpreted lambda at about four times the cost.
    """
    empty = F.array().cast("array<string>")
    if not rules:
        return empty
    text = F.concat_ws(",", *[F.when(r.broken, F.lit(r.id)) for r in rules])
    return F.when(text == "", empty).otherwise(F.split(text, ","))


@dataclass(frozen=True)
class RuleBook:
    """Critical rules send a row to quarantine, alert rules only mark it."""

    critical: tuple[Rule, ...]
    alert: tuple[Rule, ...] = ()

    def tag(self, df: DataFrame) -> DataFrame:
        return df.withColumns({CRITICAL: broken_ids(self.critical), ALERT: broken_ids(self.alert)})

    def ids(self) -> list[str]:
        return [r.id for r in (*self.critical, *self.alert)]


def clean_rows(tagged: DataFrame, helper_columns: Iterable[str] = ()) -> DataFrame:
    """Rows without a critical violation, with status and alert list."""
    return (
        tagged.filter(F.size(CRITICAL) == 0)
        .withColumns(
            {
                "quality_status": F.when(F.size(ALERT) == 0, VALID_STATUS).otherwise(ALERT_STATUS),
                "quality_alerts": F.col(ALERT),
            }
        )
        .drop(CRITICAL, ALERT, *helper_columns)
    )


def quarantine_rows(
    tagged: DataFrame,
    source: str,
    record_key: Column,
    detected_at: Column,
    helper_columns: Sequence[str] = (),
) -> DataFrame:
    """Rows with a critical violation in the common quarantine layout, original fields kept as JSON."""
    payload = [c for c in tagged.columns if c not in (CRITICAL, ALERT, *helper_columns)]
    return tagged.filter(F.size(CRITICAL) > 0).select(
        F.lit(source).alias("source_table"),
        "ingestion_date",
        "batch_id",
        record_key.alias("record_key"),
        F.lit(SEVERITY).alias("quality_severity"),
        F.col(CRITICAL).alias("quality_rules"),
        F.concat(F.lit(MESSAGE_PREFIX), F.array_join(CRITICAL, "; ")).alias("quality_message"),
        row_json(*payload).alias("payload_json"),
        detected_at.alias("detected_at"),
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
