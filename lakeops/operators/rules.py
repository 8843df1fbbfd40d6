"""Declarative row rules: clean rows, quarantined rows with a reason, and an issue log.

All rules of a table are judged in one pass over its rows. A row keeps the reason of the
first rule it breaks; nothing is dropped without ending up in the quarantine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "quarantine_reason"
RAW = "_raw"


@dataclass(frozen=True)
class Rule:
    """Rows for which ``broken`` is true leave the table; null counts as not broken."""

    reason: str
    broken: Column
    action: str = "dropped"


@dataclass(frozen=True)
class Note:
    """Rows for which ``seen`` is true are only counted; ``seen`` may look at the reason."""

    issue: str
    seen: Column
    action: str


@dataclass(frozen=True)
class Counts:
    """Issues (table, issue, rows, action) and the row counts (table, raw, clean, dropped) of one table."""

    issues: list[tuple[str, str, int, str]]
    rows: tuple[str, int, int, int]


@dataclass
class Judged:
    """A table after its rules ran: cleaned columns, the reason and the raw row."""

    table: str
    rows: DataFrame
    rules: Sequence[Rule]
    notes: Sequence[Note] = field(default_factory=list)

    @property
    def clean(self) -> DataFrame:
        return self.rows.filter(F.col(REASON).isNull()).drop(REASON, RAW)

    @property
    def quarantine(self) -> DataFrame:
        return self.rows.filter(F.col(REASON).isNotNull()).select(REASON, f"{RAW}.*")

    def with_rows(self, rows: DataFrame) -> Judged:
        """The same table read back from where its rows were written."""
        return Judged(self.table, rows, self.rules, self.notes)

    def _counted(self) -> list[tuple[str, Column, str]]:
        """Name, condition and action of every rule and note."""
        counted = [(rule.reason, F.col(REASON) == rule.reason, rule.action) for rule in self.rules]
        return counted + [(note.issue, note.seen, note.action) for note in self.notes]

    def counted_while_written(self) -> tuple[DataFrame, Callable[[], Counts]]:
        """The rows, to be written once, and a function that gives their counts after that; nothing is read again."""
        seen = Observation()

        def times(condition: Column, name: str) -> Column:
            # In an observation count_if costs several times what all else of the row does; a sum costs next to nothing.
            return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).alias(name)

        tests = [times(condition, f"_{i}") for i, (_, condition, _) in enumerate(self._counted())]
        dropped = times(F.col(REASON).isNotNull(), "_dropped")

        def counts() -> Counts:
            found = seen.get
            issues = [
                (self.table, name, found[f"_{i}"], action)
                for i, (name, _, action) in enumerate(self._counted())
                if found[f"_{i}"]
            ]
            raw, gone = found["_raw"], found["_dropped"] or 0  # no rows have no sum
            return Counts(issues, (self.table, raw, raw - gone, gone))

        return self.rows.observe(seen, F.count(F.lit(1)).alias("_raw"), dropped, *tests), counts

    def issues(self) -> DataFrame:
        """``(table, issue, rows, action)`` for every rule and note that met a row; one pass."""
        counted = self._counted()
        totals = self.rows.agg(*[F.count_if(seen).alias(f"_{i}") for i, (_, seen, _) in enumerate(counted)])
        entries = [
            F.struct(
                F.lit(self.table).alias("table"),
                F.lit(issue).alias("issue"),
                F.col(f"_{i}").alias("rows"),
                F.lit(action).alias("action"),
            )
            for i, (issue, _, action) in enumerate(counted)
        ]
        return totals.select(F.inline(F.array(*entries))).filter("rows > 0")

    def row_counts(self) -> DataFrame:
        dropped = F.count_if(F.col(REASON).isNotNull())
        return self.rows.agg(
            F.lit(self.table).alias("table"),
            F.count(F.lit(1)).alias("raw"),
            (F.count(F.lit(1)) - dropped).alias("clean"),
            dropped.alias("dropped"),
        )


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the reason of the first broken rule, or null. The row as it came in stays only where there is a reason."""
    reasons = [F.when(F.coalesce(rule.broken, F.lit(False)), F.lit(rule.reason)) for rule in rules]
    judged = df.withColumn(REASON, F.coalesce(*reasons))
    return judged.withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.col(RAW))) if RAW in df.columns else judged


def whole_row(df: DataFrame) -> Column:
    """The row as it came in, kept aside for the quarantine."""
    return F.struct(*df.columns).alias(RAW)


def one_of(value: Column, allowed: Sequence[str]) -> Column:
    """Membership that is false, not null, for a missing value."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def clamp(value: Column, low, high, missing=0) -> Column:
    """Force into the range; a missing value becomes ``missing``."""
    return F.least(F.greatest(F.coalesce(value, F.lit(missing)), F.lit(low)), F.lit(high))
