"""Distinct voters by first appearance, and repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import normalize_method, pack_bits
from tallyframe.operators.roster import APPEARANCE, first_appearance_rank


def first_seen_counts(rows: DataFrame) -> DataFrame:
    """AGG06: ev_date, county, voting_method, n: voters by their first appearance.

    The first is the least (day, row_hash, occ); it is found by a grouped minimum, which keeps one small row
    per voter before the shuffle. A first appearance of unknown method has a null voting_method."""
    first = rows.groupBy("id_voter").agg(F.min_by(F.struct("ev_date", F.upper(F.trim("county")).alias("county"), normalize_method("voting_method").alias("voting_method")), F.struct(*APPEARANCE)).alias("x"))
    return first.groupBy("x.ev_date", "x.county", "x.voting_method").agg(F.count("*").alias("n"))


def distinct_annotations(days: DataFrame, first_seen: DataFrame) -> DataFrame:
    """AGG07: a day series (ev_date, total) with new voters, restated rows and cumulative unique voters.

    restated_rows: rows beyond the new voters, 0 at least. A day that the counts don't name has null new
    voters, and from there on cumulative ones are null (WIN02)."""
    new = first_seen.where("voting_method is not null").groupBy("ev_date").agg(F.sum("n").alias("new_voters"), F.sum(F.when(F.col("voting_method") == "in_person", F.col("n")).otherwise(0)).alias("new_in_person"), F.sum(F.when(F.col("voting_method") == "mail_in", F.col("n")).otherwise(0)).alias("new_mail_in"))
    out = days.join(new, "ev_date", "left").withColumn("restated_rows", F.greatest(F.col("total") - F.col("new_voters"), F.lit(0)))
    out = out.withColumn("restated_rows", F.when(F.col("new_voters").isNotNull(), F.col("restated_rows")))
    return cumulative_unique_voters(out)


def cumulative_unique_voters(days: DataFrame) -> DataFrame:
    """WIN02: running new voters over ev_date; null from the first null on."""
    upto = Window.orderBy("ev_date").rowsBetween(Window.unboundedPreceding, 0)
    broken = F.max(F.col("new_voters").isNull()).over(upto)
    return days.withColumn("cumulative_unique_voters", F.when(~broken, F.sum("new_voters").over(upto)))


def repeat_excess(rows: DataFrame) -> DataFrame:
    """AGG08: ev_date, county, voting_method, n: appearances that aren't a voter's first.

    All appearances less the first ones, both from grouped aggregates: no voter's rows are ranked."""
    slices = ["ev_date", "county", "voting_method"]
    every = rows.groupBy("ev_date", F.upper(F.trim("county")).alias("county"), normalize_method("voting_method").alias("voting_method")).agg(F.count("*").alias("n"))
    both = every.unionByName(first_seen_counts(rows).withColumn("n", -F.col("n")))
    return both.groupBy(*slices).agg(F.sum("n").alias("n")).where("n > 0")


def repeat_voters(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG09: per voter who is counted more than once or was removed: n_counted, n_removed, first_day,
    counted_days, removed_days and flags.

    flags: 1 several rows on one day, 2 several days, 4 several methods, 8 removed. ``removals``: id_voter,
    ev_date of removals from the change log. Only sets of days are gathered, which are as many as an election
    has; ``repeat_appearances`` gives the appearances themselves, as rows."""
    method = F.coalesce(normalize_method("voting_method"), F.lit(""))
    seen = rows.groupBy("id_voter").agg(F.count("*").alias("n_counted"), F.array_sort(F.collect_set("ev_date")).alias("days"), (F.min(method) != F.max(method)).alias("methods"))
    gone = removals.groupBy("id_voter").agg(F.count("*").alias("n_removed"), F.array_sort(F.collect_set("ev_date")).alias("removed_days"))
    both = seen.where("n_counted > 1").join(gone, "id_voter", "full_outer")
    # a removed voter's single appearance counts too
    single = seen.where("n_counted = 1").join(gone, "id_voter", "left_semi").withColumnsRenamed({c: f"one_{c}" for c in ("n_counted", "days", "methods")})
    both = both.join(single, "id_voter", "left")
    none = F.array().cast("array<date>")
    n, days = F.coalesce("n_counted", "one_n_counted", F.lit(0)).cast("int"), F.coalesce("days", "one_days", none)
    removed = F.coalesce("n_removed", F.lit(0))
    flags = pack_bits(F.size(days) < n, F.size(days) > 1, F.coalesce("methods", F.lit(False)), removed > 0)
    return both.select("id_voter", n.alias("n_counted"), removed.alias("n_removed"), F.get(days, F.lit(0)).alias("first_day"), days.alias("counted_days"), F.coalesce("removed_days", none).alias("removed_days"), flags.alias("flags"))


def repeat_appearances(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG09: id_voter, place (from 1), ev_date, method, county: the appearances, in order, of voters who appear
    more than once or were removed."""
    several = rows.groupBy("id_voter").agg(F.count("*").alias("n")).where("n > 1").select("id_voter")
    wanted = several.union(removals.select("id_voter")).distinct()
    ranked = first_appearance_rank(rows.join(wanted, "id_voter", "left_semi"))
    return ranked.select("id_voter", F.col("rank").alias("place"), "ev_date", normalize_method("voting_method").alias("method"), F.upper(F.trim("county")).alias("county"))


def repeat_summary(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG10: raw_rows, distinct_voters, repeat_voters, excess, removed_voters in one row."""
    per_voter = rows.groupBy("id_voter").agg(F.count("*").alias("n"))
    counts = per_voter.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), F.count("*").alias("distinct_voters"), F.count_if(F.col("n") > 1).alias("repeat_voters"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))
    return counts.crossJoin(F.broadcast(removals.agg(F.count_distinct("id_voter").alias("removed_voters"))))


# Kept up by days: a cell is what one voter's rows of one day say, so a day that is published again replaces its
# cells, and only voters whose cells differ are looked at anew.

CELL = ("id_voter", "ev_date")


def voter_cells(rows: DataFrame) -> DataFrame:
    """AGG06-AGG10, state: per voter and day n, first (day, row_hash, occ), the county and method of that row, and the
    least and greatest method. Combined before the shuffle; of a day's size at most."""
    method = normalize_method("voting_method")
    named = F.coalesce(method, F.lit(""))
    at = F.struct(*APPEARANCE)
    return rows.groupBy(*CELL).agg(
        F.count("*").alias("n"),
        F.min(at).alias("first"),
        F.min_by(F.struct(F.upper(F.trim("county")).alias("county"), method.alias("voting_method")), at).alias("slice"),
        F.min(named).alias("least_method"),
        F.max(named).alias("most_method"),
    )


def changed_voters(old: DataFrame, new: DataFrame) -> DataFrame:
    """id_voter of those whose cells of the changed days differ, come or go; ``old`` and ``new`` hold those days alone."""
    values = F.struct("n", "first", "slice", "least_method", "most_method")
    both = old.select(*CELL, values.alias("a")).join(new.select(*CELL, values.alias("b")), list(CELL), "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("id_voter").distinct()


def replaced_days(cells: DataFrame, new: DataFrame, days: DataFrame) -> DataFrame:
    """All cells after the days (ev_date) have been published again. Stored by ev_date, only their partitions change."""
    return cells.join(F.broadcast(days.select("ev_date").distinct()), "ev_date", "left_anti").unionByName(new)


def first_seen_of_cells(cells: DataFrame) -> DataFrame:
    """AGG06 from cells."""
    first = cells.groupBy("id_voter").agg(F.min_by(F.struct("ev_date", "slice"), "first").alias("x"))
    return first.groupBy("x.ev_date", "x.slice.county", "x.slice.voting_method").agg(F.count("*").alias("n"))


def excess_of_cells(cells: DataFrame, rows_by_slice: DataFrame) -> DataFrame:
    """AGG08 from cells and all rows' counts per (ev_date, county, voting_method)."""
    both = rows_by_slice.unionByName(first_seen_of_cells(cells).withColumn("n", -F.col("n")))
    return both.groupBy("ev_date", "county", "voting_method").agg(F.sum("n").alias("n")).where("n > 0")


def updated_first_seen(counts: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """AGG06 kept up: ``counts`` less what the touched voters' cells gave before, with what they give after. ``before`` and
    ``after`` are the cells of those voters only."""
    parts = counts.unionByName(first_seen_of_cells(before).withColumn("n", -F.col("n"))).unionByName(first_seen_of_cells(after))
    return parts.groupBy("ev_date", "county", "voting_method").agg(F.sum("n").alias("n")).where("n != 0")


def repeats_of_cells(cells: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG09 from cells: as ``repeat_voters``."""
    seen = cells.groupBy("id_voter").agg(F.sum("n").alias("n"), F.array_sort(F.collect_set("ev_date")).alias("days"), (F.min("least_method") != F.max("most_method")).alias("methods"))
    gone = removals.groupBy("id_voter").agg(F.count("*").alias("n_removed"), F.array_sort(F.collect_set("ev_date")).alias("removed_days"))
    both = seen.join(gone, "id_voter", "full_outer").where("n > 1 or n_removed is not null")
    n, days, removed = F.coalesce("n", F.lit(0)).cast("int"), F.coalesce("days", F.array().cast("array<date>")), F.coalesce("n_removed", F.lit(0))
    flags = pack_bits(F.size(days) < n, F.size(days) > 1, F.coalesce("methods", F.lit(False)), removed > 0)
    return both.select("id_voter", n.alias("n_counted"), removed.alias("n_removed"), F.get(days, F.lit(0)).alias("first_day"), days.alias("counted_days"), F.coalesce("removed_days", F.array().cast("array<date>")).alias("removed_days"), flags.alias("flags"))


def updated_repeats(repeats: DataFrame, touched: DataFrame, after: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG09 kept up: rows of voters that aren't touched stay as they are; the touched ones' come from their cells
    (``after``) and all their removals."""
    own = removals.join(touched, "id_voter", "left_semi")
    return repeats.join(touched, "id_voter", "left_anti").unionByName(repeats_of_cells(after, own))


def updated_summary(cells: DataFrame, removals: DataFrame) -> DataFrame:
    """AGG10 from cells."""
    per_voter = cells.groupBy("id_voter").agg(F.sum("n").alias("n"))
    counts = per_voter.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"), F.count("*").alias("distinct_voters"), F.count_if(F.col("n") > 1).alias("repeat_voters"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))
    return counts.crossJoin(F.broadcast(removals.agg(F.count_distinct("id_voter").alias("removed_voters"))))
