"""Separate rows that cannot be used from rows that can; none is lost."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hireflow.functions.dates import try_timestamp
from hireflow.functions.text import clean
from hireflow.sources.readers import CORRUPT
from hireflow.sources.schemas import SOURCES

#: Reason of a line that could not be read at all.
UNREADABLE = "line unreadable"

Rules = dict[str, Callable[[], dict[str, Column]]]


def tag_malformed(scanned: DataFrame) -> DataFrame:
    """Mark lines the parser could not read; they keep their text in ``_corrupt_record``."""
    return scanned.withColumn("_quarantined", F.col(CORRUPT).isNotNull())


def tag_rejects(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Add ``_reject_reasons``: the names of all rules a row breaks, empty for a good row."""
    broken = [F.when(rule, F.lit(name)) for name, rule in reasons.items()]
    return df.withColumn("_reject_reasons", F.array_compact(F.array(*broken)))


def write_split(tagged: DataFrame, path: str) -> None:
    """Good and quarantined rows into two partitions by one pass over the input."""
    tagged.withColumn("_quarantined", F.size("_reject_reasons") > 0).write.partitionBy(
        "_quarantined"
    ).mode("overwrite").parquet(path)


def event_rules(
    application_id: Column | None = None,
    new_status: Column | None = None,
    event_timestamp: Column | None = None,
) -> dict[str, Column]:
    """What makes a cleaned workflow event unusable."""
    cells = {
        "application_id missing": (application_id, "application_id"),
        "new_status missing": (new_status, "new_status"),
        "event_timestamp unreadable": (event_timestamp, "event_timestamp"),
    }
    return {
        reason: (F.col(name) if cell is None else cell).isNull()
        for reason, (cell, name) in cells.items()
    }


def raw_event_rules() -> dict[str, Column]:
    """The same for an event as it arrives."""
    return event_rules(
        _filled("application_id"), _filled("new_status"), try_timestamp(F.col("event_timestamp"))
    )


def _filled(name: str) -> Column:
    return F.nullif(clean(F.col(name)), F.lit(""))


def load_rules() -> Rules:
    """Rules by source: every row needs its key, an event a status and a readable time as well."""
    rules: Rules = {
        name: lambda key=spec.key: {f"{key} missing": _filled(key).isNull()}
        for name, spec in SOURCES.items()
    }
    return rules | {"workflow_events": raw_event_rules}


def tag_for_load(scanned: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Mark unreadable lines and rows that break a rule, with all reasons, in the pass that loads."""
    unreadable = F.col(CORRUPT).isNotNull()
    # an unreadable line has no values, so no rule says more about it
    reasons = {UNREADABLE: unreadable} | {k: ~unreadable & rule for k, rule in rules.items()}
    return tag_rejects(scanned, reasons).withColumn("_quarantined", F.size("_reject_reasons") > 0)
