"""Plans that put operators together: the by-day series and the ingest of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyframe.operators.aggregates import by_day_series, running_totals
from tallyframe.operators.distinct import distinct_annotations, first_seen_counts
from tallyframe.operators.roster import canonical_rows
from tallyframe.operators.versions import load_day_version, publish_check, replace_day


def day_series(rows: DataFrame) -> DataFrame:
    """Per day: totals by method, running totals, new voters, restated rows, cumulative unique voters.

    ``rows``: roster rows with day, row_hash, occ. Two shuffles of the rows, both of partial aggregates; all
    that follows works on one row per day."""
    return distinct_annotations(running_totals(by_day_series(rows)), first_seen_counts(rows))


def ingest_day(stored: DataFrame | None, file: DataFrame, version: int, n_rejects: int, n_lines: int) -> DataFrame:
    """A day's rows after loading a file's valid rows as the next version. Raises if the visible rows and
    rejects aren't the file's lines; the caller publishes the frame and then the manifest."""
    new = canonical_rows(file)
    if stored is None:
        empty = new.limit(0).selectExpr("*", "cast(null as int) added_in", "cast(null as int) removed_in")
        rows = replace_day(empty, new, version)
    else:
        rows = load_day_version(stored, new, version)
    check = publish_check(rows, version + 1, n_rejects, n_lines).first()
    if not check["ok"]:
        raise ValueError(f"{check['visible']} visible rows and {n_rejects} rejects of {n_lines} lines")
    return rows
