"""Expectations: named conditions that warn, drop rows or fail the job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluiceway.functions.text import is_json_sql


class ExpectationFailed(RuntimeError):
    """A condition with the action ``fail`` was violated."""


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r} of expectation {self.name}")

    def holds(self) -> Column:
        """TRUE only where the condition is TRUE; NULL counts as a violation."""
        return F.coalesce(F.expr(self.condition), F.lit(False))


# Names, conditions and actions of the expectations.
BRONZE_RESPONSES = (
    Expectation("has_endpoint", "endpoint IS NOT NULL"),
    Expectation("nonempty_success_body", "response_body IS NULL OR length(response_body) > 0"),
)
SILVER_RECORDS = (
    Expectation("successful_response", "status_code BETWEEN 200 AND 299", "drop"),
    Expectation("has_record_key", "record_id IS NOT NULL", "drop"),
    Expectation("body_was_parseable", "record_json IS NOT NULL"),
)
SILVER_DOCUMENTS = (
    Expectation("successful_response", "status_code BETWEEN 200 AND 299", "drop"),
    Expectation("body_was_parseable", "response_variant IS NOT NULL"),
)
SILVER_FILES = (Expectation("no_schema_drift", "_rescued_data IS NULL"),)
# Seen on bronze, before the silver parse leaves such bodies out. Stricter than that parse, which
# lets text follow the first value.
UNPARSEABLE = Expectation(
    "unparseable_responses", f"response_body IS NULL OR {is_json_sql('response_body')}"
)


def drop_violations(df: DataFrame, expectations: Iterable[Expectation]) -> DataFrame:
    for rule in expectations:
        if rule.action == "drop":
            df = df.filter(rule.holds())
    return df


def measures(expectations: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~rule.holds()).alias(rule.name) for rule in expectations
    ]


def report(df: DataFrame, table: str, expectations: Sequence[Expectation], batch_id: int = 0) -> DataFrame:
    """One row per expectation, counted in a single pass over the rows."""
    counted = df.agg(*measures(expectations))
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("expectation"),
                F.lit(rule.action).alias("action"),
                F.col(rule.name).alias("violations"),
            )
            for rule in expectations
        ]
    )
    return counted.select(
        F.lit(table).alias("table"), F.lit(batch_id).cast("bigint").alias("batch_id"), "rows",
        F.explode(lines).alias("line"),
    ).select("table", "line.expectation", "line.action", "batch_id", "rows", "line.violations")


def watch(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[DataFrame, Observation]:
    """Count violations while the rows pass through to their sink; no scan of its own."""
    seen = Observation()
    return df.observe(seen, *measures(expectations)), seen


def events(counts: dict, table: str, expectations: Sequence[Expectation], batch_id: int) -> list[tuple]:
    """Observed counts as rows of the ``quality_events`` table; an empty batch observes nothing."""
    return [
        (table, rule.name, rule.action, batch_id, counts.get("rows", 0), counts.get(rule.name, 0))
        for rule in expectations
    ]


def refuse(df: DataFrame, table: str, expectations: Sequence[Expectation], batch_id: int) -> None:
    """Raise before anything is written where a ``fail`` condition is violated; one scan of what it needs."""
    _raise_broken(events(df.agg(*measures(expectations)).first().asDict(), table, expectations, batch_id), table)


def check(seen: Observation, table: str, expectations: Sequence[Expectation], batch_id: int) -> list[tuple]:
    """Quality events of a finished write; raises where a ``fail`` condition was violated."""
    found = events(seen.get, table, expectations, batch_id)
    _raise_broken(found, table)
    return found


def _raise_broken(found: list[tuple], table: str) -> None:
    broken = [name for _, name, action, _, _, violations in found if action == "fail" and violations]
    if broken:
        raise ExpectationFailed(f"{table}: {', '.join(broken)}")


EVENT_SCHEMA = (
    "`table` string, expectation string, action string, batch_id bigint, rows bigint, violations bigint"
)
