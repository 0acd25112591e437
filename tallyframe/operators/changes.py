"""Differences between two files of a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import zfill
from tallyframe.operators.roster import last_row


def diff_rosters(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """JON14, SET02: change_kind (added, removed), ``by``, id_voter, county, voting_method.

    Of a voter's rows in a file the last (``pos``) counts; a blank id and that of zeros only are skipped.
    Counties and methods are trimmed and upper-cased, a null one is empty. ``by``: columns (the day, say) that
    tell apart several files on each side."""
    key = [*by, "id_voter"]
    tidy = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))).alias(c)

    def voters(df: DataFrame, side: str) -> DataFrame:
        padded = df.withColumn("id_voter", zfill(F.trim("id_voter"), 10)).where("id_voter not in ('', '0000000000')")
        rows = last_row(padded.select(*key, tidy("county"), tidy("voting_method"), "pos"), key, ["pos"])
        # a struct is null only where the voter isn't in the file, whatever its cells hold
        return rows.select(*key, F.struct("county", "voting_method").alias(side))

    both = voters(old, "a").join(voters(new, "b"), key, "full_outer")
    changed = both.where(F.col("a").isNull() | F.col("b").isNull())
    kept = F.coalesce("a", "b")
    return changed.select(F.when(F.col("a").isNull(), "added").otherwise("removed").alias("change_kind"), *key, kept["county"].alias("county"), kept["voting_method"].alias("voting_method"))


def compare_snapshots(prior: DataFrame, current: DataFrame) -> DataFrame:
    """JON15, SET04: id_voter, anomaly_kind, county, voting_method, prior_county, prior_voting_method,
    occurrence_count: repeats within the current file, voters that it dropped, and voters whose SET of
    methods or counties differs. First rows (``pos``) stand for a voter; of several other values of a
    repeat the least is named."""
    def voters(df: DataFrame, name: str) -> DataFrame:
        row = F.min_by(F.struct("county", "voting_method"), "pos")
        return df.groupBy("id_voter").agg(F.struct(row.alias("first"), F.array_sort(F.collect_set("county")).alias("counties"), F.array_sort(F.collect_set("voting_method")).alias("methods"), F.count("*").alias("n")).alias(name))

    both = voters(prior, "p").join(voters(current, "c"), "id_voter", "full_outer")
    other = lambda values, first: F.array_min(F.filter(values, lambda v: v != first))
    none = F.lit(None).cast("string")
    here = both["p"].isNotNull() & both["c"].isNotNull()

    def finding(kind: str, county, method, prior_county, prior_method, n):
        return F.struct(F.lit(kind).alias("anomaly_kind"), county.alias("county"), method.alias("voting_method"), prior_county.alias("prior_county"), prior_method.alias("prior_voting_method"), n.alias("occurrence_count"))

    c, p, one = F.col("c.first"), F.col("p.first"), F.lit(1).cast("long")
    found = F.array_compact(
        F.array(
            F.when(F.col("c.n") > 1, finding("within_file_dup", c["county"], c["voting_method"], other(F.col("c.counties"), c["county"]), other(F.col("c.methods"), c["voting_method"]), F.col("c.n"))),
            F.when(both["c"].isNull(), finding("dropped_from_later", none, none, p["county"], p["voting_method"], one)),
            F.when(here & (F.col("p.methods") != F.col("c.methods")), finding("method_changed", c["county"], c["voting_method"], p["county"], p["voting_method"], one)),
            F.when(here & (F.col("p.counties") != F.col("c.counties")), finding("county_changed", c["county"], c["voting_method"], p["county"], p["voting_method"], one)),
        )
    )
    return both.select("id_voter", F.explode(found).alias("x")).select("id_voter", "x.*")


def anomaly_day_view(anomalies: DataFrame) -> DataFrame:
    """AGG15: per ev_date the distinct voters of each kind, excess rows of repeats, and how many of them
    differ in method or county."""
    kinds = ("within_file_dup", "dropped_from_later", "method_changed", "county_changed")
    within = F.col("anomaly_kind") == "within_file_dup"
    counts = [F.count_distinct(F.when(F.col("anomaly_kind") == k, F.col("id_voter"))).alias(k) for k in kinds]
    return anomalies.groupBy("ev_date").agg(
        *counts,
        F.sum(F.when(within, F.col("occurrence_count") - 1).otherwise(0)).alias("excess_rows"),
        F.count_if(within & F.col("prior_voting_method").isNotNull()).alias("multi_method"),
        F.count_if(within & F.col("prior_county").isNotNull()).alias("multi_county"),
    )


def change_log(old: DataFrame, new: DataFrame, election_id: str, ev_date: str, old_sha: str, new_sha: str, recorded_at: str) -> DataFrame:
    """VER07: the rows to append when a day's file is replaced; none where the sha is the same."""
    changes = diff_rosters(old, new) if old_sha != new_sha else diff_rosters(old, new).limit(0)
    return changes.select(F.lit(election_id).alias("election_id"), F.lit(ev_date).cast("date").alias("ev_date"), F.lit(old_sha).alias("old_sha256"), F.lit(new_sha).alias("new_sha256"), "change_kind", "id_voter", "county", "voting_method", F.lit(recorded_at).cast("timestamp").alias("recorded_at"))


def day_status(stored: DataFrame, new: DataFrame) -> DataFrame:
    """PRJ11: ev_date, status and the sha to keep: unchanged, changed, skipped_empty, or failed, where the
    stored one stays (``new``: ev_date, sha256, n_rows, error)."""
    joined = new.join(stored.select("ev_date", F.col("sha256").alias("stored_sha256")), "ev_date", "full_outer")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("sha256").isNull(), "unchanged").when(F.col("n_rows") == 0, "skipped_empty").when(F.col("sha256").eqNullSafe(F.col("stored_sha256")), "unchanged").otherwise("changed")
    out = joined.withColumn("status", status)
    return out.select("ev_date", "status", F.when(F.col("status") == "changed", F.col("sha256")).otherwise(F.col("stored_sha256")).alias("sha256"))
