"""Versioned rows: what a day's new file adds and closes, and what readers see.

Nothing is changed in place. A new version is a frame that is written to a new directory; the manifest's
row comes last, and readers find the directory through it (``sources.sinks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import day_digest

KEY = ("day", "row_hash", "occ")


def live_rows(df: DataFrame) -> DataFrame:
    """PRJ04."""
    return df.where("removed_in is null")


def visible_at(df: DataFrame, version: int) -> DataFrame:
    """PRJ05: the rows of version V: added_in <= V and not removed by then."""
    return df.where((F.col("added_in") <= version) & (F.col("removed_in").isNull() | (F.col("removed_in") > version)))


def recovered(df: DataFrame, version: int) -> DataFrame:
    """VER04: the rows as of the marker's version: later ones are left out, later removals undone."""
    return df.where(F.col("added_in") <= version).withColumn("removed_in", F.when(F.col("removed_in") <= version, F.col("removed_in")))


def load_day_version(stored: DataFrame, new: DataFrame, version: int, key: Sequence[str] = KEY) -> DataFrame:
    """VER01, VER03: all rows of a day after loading ``new`` as version + 1.

    Rows whose key stays are untouched; new keys are added at version + 1 (a key that was removed before gets
    a row of its own again, so readers of old versions see what they saw, and a key may have several rows, one
    of them live); keys that are gone are closed there. Same keys on both sides give the rows as they are."""
    live = live_rows(stored)
    closed = stored.where("removed_in is not null")
    kept = live.join(new.select(*key, F.lit(True).alias("__here")), list(key), "left")
    kept = kept.withColumn("removed_in", F.when(F.col("__here").isNull(), version + 1)).select(*stored.columns)
    added = new.join(live.select(*key), list(key), "left_anti").withColumn("added_in", F.lit(version + 1)).withColumn("removed_in", F.lit(None).cast("int"))
    return kept.unionByName(added.select(*stored.columns)).unionByName(closed)


def replace_day(stored: DataFrame, new: DataFrame, version: int) -> DataFrame:
    """VER02: where the base is gone, close all live rows and add all new ones."""
    closed = stored.withColumn("removed_in", F.coalesce("removed_in", F.lit(version + 1)))
    return closed.unionByName(new.withColumn("added_in", F.lit(version + 1)).withColumn("removed_in", F.lit(None).cast("int")).select(*stored.columns))


def same_keys(stored: DataFrame, new: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row: how many keys are added and removed; where both are 0 only the marker changes."""
    both = live_rows(stored).select(*key, F.lit(1).alias("a")).join(new.select(*key, F.lit(1).alias("b")), list(key), "full_outer")
    return both.agg(F.count_if(F.col("a").isNull()).alias("added"), F.count_if(F.col("b").isNull()).alias("removed"))


def publish_check(rows: DataFrame, version: int, n_rejects: int, n_lines: int) -> DataFrame:
    """VER05: visible rows and rejects must be the file's lines; ``ok`` says whether to publish."""
    return visible_at(rows, version).agg(F.count("*").alias("visible")).withColumn("ok", F.col("visible") + n_rejects == n_lines)


def collected(df: DataFrame, version: int) -> DataFrame:
    """VER06: without the rows removed at or before a version."""
    return df.where(F.col("removed_in").isNull() | (F.col("removed_in") > version))


def stale_files(files: DataFrame, keep: Sequence[DataFrame]) -> DataFrame:
    """VER08, SET03: ids in ``files`` that no frame of ``keep`` names."""
    kept = keep[0].select("file_id")
    for frame in keep[1:]:
        kept = kept.union(frame.select("file_id"))
    return files.select("file_id").distinct().join(kept.distinct(), "file_id", "left_anti")


def with_defaults(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """VER09: columns that older files lack, with their type and default; nulls in them get it too."""
    for name, (kind, default) in columns.items():
        value = F.lit(default).cast(kind)
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def build_signature(versions: DataFrame, columns: Sequence[str], extra: str = "") -> DataFrame:
    """AGG24: one sha256 over the manifest's rows, in any order, and other inputs; an equal one skips a build."""
    lines = F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
    return versions.agg(F.sha2(F.concat_ws("\n", day_digest(lines), F.lit(extra)), 256).alias("signature"))


def diff_upsert(stored: DataFrame, new: DataFrame, key: Sequence[str], value_hash: str) -> tuple[DataFrame, DataFrame]:
    """SNK06: rows to write (new, or of another hash) and keys to delete, from one full outer join each
    side of which is shuffled once."""
    both = stored.select(*key, F.col(value_hash).alias("__old")).join(new.withColumn("__new", F.col(value_hash)), list(key), "full_outer")
    return both.where("__new is not null and (__old is null or __old != __new)").select(*new.columns), both.where("__new is null").select(*key)


def complete_days(days: DataFrame, files: DataFrame, chunks: DataFrame) -> DataFrame:
    """JON12: days whose file (id and sha agree) has all the chunks that it should."""
    present = chunks.groupBy("file_id").agg(F.count("*").alias("present"))
    return days.join(files, ["file_id", "sha256"]).join(present, "file_id").where("present = n_chunks").select(*days.columns)


def choose_published(pointers: DataFrame, files: DataFrame) -> DataFrame:
    """JON13: per election the pointer's file if it is complete and has the published sha, else any complete
    file that has it, the least id; an empty sha gives none."""
    ok = files.where("complete").join(pointers.where("sha256 != ''").withColumnRenamed("file_id", "__pointer"), ["election_id", "sha256"])
    choice = F.min(F.struct((F.col("file_id") != F.col("__pointer")).alias("other"), "file_id"))
    return ok.groupBy("election_id").agg(choice.alias("c")).select("election_id", F.col("c.file_id").alias("file_id"), F.when(F.col("c.other"), "matching").otherwise("pointer").alias("how"))


def plan_load_days(calendar: DataFrame, today: str) -> DataFrame:
    """PRJ09: election_id, ev_date, period for the days to load: those listed and the election day, up to today."""
    every = calendar.select("election_id", "election_date", F.explode(F.array_distinct(F.concat("dates", F.array("election_date")))).alias("ev_date"))
    period = F.when(F.col("ev_date") == F.col("election_date"), "election_day").otherwise("early")
    return every.where(F.col("ev_date") <= F.lit(today).cast("date")).select("election_id", "ev_date", period.alias("period"))


def latest_loadable_day(days: DataFrame, counts: DataFrame) -> DataFrame:
    """PRJ10: per election the newest planned day that has rows."""
    return days.join(counts.where("n > 0"), ["election_id", "ev_date"]).groupBy("election_id").agg(F.max("ev_date").alias("ev_date"))


def stale_elections(index: DataFrame, now: str, max_age_hours: float) -> DataFrame:
    """PRJ14: elections last refreshed (or, never so, modified) too long ago; an age of 0 or less takes all."""
    if max_age_hours <= 0:
        return index
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.coalesce("last_refreshed", "modified"))
    return index.where(seconds >= max_age_hours * 3600)


def keyset_page(rows: DataFrame, after: tuple[int, int], n: int) -> DataFrame:
    """TOP03: the next n rows by (row_hash, occ)."""
    return rows.where(F.struct("row_hash", "occ") > F.struct(F.lit(after[0]).cast("long").alias("row_hash"), F.lit(after[1]).cast("int").alias("occ"))).orderBy("row_hash", "occ").limit(n)


def hash_page(rows: DataFrame, low: int, high: int) -> DataFrame:
    """TOP04: the rows of a hash range."""
    return rows.where(F.col("row_hash").between(low, high))
