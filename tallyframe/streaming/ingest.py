"""Incremental ingest by Structured Streaming (STR01-STR05)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallyframe.functions.scalars import canonical_line, day_digest
from tallyframe.operators.aggregates import by_day_series
from tallyframe.operators.changes import diff_rosters


#: A voter's appearances that are one value of state; of a voter of more each is an entry of a map.
SMALL = 1 << 16
#: Rows of a day's file, about.
FILE_ROWS = 1 << 20
MANIFEST = "ev_date date, sha256 string, n_rows long, load string"
MARKERS = "file_name string, n_rows long, load string"


def publish_load(rows: DataFrame, folder: str, load: str, kind: str = "parquet") -> None:
    """Write one load of days as ``load=...`` under ``folder``/rows and, last, its marker: which files it has and how many
    rows each. A load without a marker isn't all there."""
    writer = rows.write.mode("overwrite").format(kind)
    if kind == "csv":
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    target = f"{folder}/rows/load={load}"
    writer.save(target)
    reader = rows.sparkSession.read.schema(rows.schema).format(kind)
    written = (reader.option("header", True).option("escape", '"') if kind == "csv" else reader).load(target)
    files = written.select("*", F.col("_metadata.file_name").alias("file_name")).groupBy("file_name").agg(F.count("*").alias("n_rows"))
    files.write.mode("overwrite").parquet(f"{folder}/markers/load={load}")


def day_files(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1, kind: str = "parquet") -> DataFrame:
    """STR01, STR04: the loads of a folder as a stream of Parquet or CSV files (``kind``; a CSV has a header), with load
    and file_name; Spark splits and decodes them, so no file is held whole."""
    reader = spark.readStream.schema(StructType([*schema.fields, StructField("load", StringType())])).option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("header", True).option("escape", '"') if kind == "csv" else reader
    return reader.format(kind).load(f"{folder}/rows").select("*", F.col("_metadata.file_name").alias("file_name"))


def ingest_days(stream: DataFrame, folder: str, path: str, checkpoint: str, content: tuple[str, ...] = ("id_voter", "county", "voting_method", "precinct")) -> StreamingQuery:
    """STR01, STR02, STR05: load each published load's days once, however its files fall into batches.

    A batch's rows are set aside; a load is judged when all files that its marker names are in with all their rows, and
    all loads before it (by name) are done. A day whose digest is stored is skipped; a changed day gets a new version, a
    partition of its digest, and rows in the change log. A batch or load that runs again overwrites what it wrote and
    sees the manifest as it was before it."""

    def arrived(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("load").parquet(f"{path}/pending/batch={batch_id}")
        settle_loads(batch.sparkSession, folder, path, content)

    return stream.writeStream.foreachBatch(arrived).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settle_loads(spark: SparkSession, folder: str, path: str, content: tuple[str, ...] = ("id_voter", "county", "voting_method", "precinct")) -> list[str]:
    """Judge all loads that are whole, in order, and name them; also for markers that came after the last batch."""
    pending = _pending(spark, path)
    if pending is None:
        return []
    known = _read(spark, f"{folder}/markers", MARKERS)
    done = _read(spark, f"{path}/done", "load string, n_days long")
    here = pending.groupBy("load", "file_name").agg(F.count("*").alias("here"))
    waiting = known.join(done, "load", "left_anti").join(here, ["load", "file_name"], "left")
    # a row per load, not per file
    state = waiting.groupBy("load").agg(F.min(F.coalesce(F.col("here") == F.col("n_rows"), F.lit(False))).alias("whole")).orderBy("load")
    settled = []
    for load, whole in state.toLocalIterator():
        if not whole:
            break
        _judge(spark, pending.where(F.col("load") == load), load, path, content)
        settled.append(load)
    return settled


def _judge(spark: SparkSession, rows: DataFrame, load: str, path: str, content: tuple[str, ...]) -> None:
    manifest = _read(spark, f"{path}/manifest", MANIFEST).where(F.col("load") < load)
    latest = manifest.groupBy("ev_date").agg(F.max_by("sha256", "load").alias("old_sha256"))
    digests = rows.groupBy("ev_date").agg(day_digest(canonical_line(content)).alias("sha256"), F.count("*").alias("n_rows"))
    changed = digests.join(latest, "ev_date", "left").where("old_sha256 is null or old_sha256 != sha256")
    # one row per day, written so that all that follows agrees
    changed.write.mode("overwrite").parquet(f"{path}/staged/load={load}")
    todo = spark.read.schema(changed.schema).parquet(f"{path}/staged/load={load}")
    days = todo.collect()  # as many as an election has days
    if days:
        placed = rows.drop("load", "file_name", "batch").join(todo.select("ev_date", "sha256", "n_rows"), "ev_date")
        part = F.pmod(F.xxhash64("id_voter", "precinct"), F.floor(F.col("n_rows") / FILE_ROWS) + 1)
        placed = placed.repartition("ev_date", "sha256", part).drop("n_rows")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ev_date", "sha256").parquet(f"{path}/days")
        both = [(d["ev_date"], d["old_sha256"], d["sha256"]) for d in days if d["old_sha256"]]
        if both:
            old, new = (_days(spark, path, [(day, shas[k]) for day, *shas in both]) for k in (0, 1))
            replaced = todo.where("old_sha256 is not null").select("ev_date", "old_sha256", F.col("sha256").alias("new_sha256"))
            changes = diff_rosters(old, new, by=("ev_date",)).join(F.broadcast(replaced), "ev_date")
            changes.write.mode("overwrite").parquet(f"{path}/changes/load={load}")
        todo.select("ev_date", "sha256", "n_rows").write.mode("overwrite").parquet(f"{path}/manifest/load={load}")
    spark.createDataFrame([(len(days),)], "n_days long").coalesce(1).write.mode("overwrite").parquet(f"{path}/done/load={load}")


def _pending(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        rows = spark.read.option("mergeSchema", False).parquet(f"{path}/pending")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows.withColumn("load", F.col("load").cast("string"))


def _days(spark: SparkSession, path: str, versions: Sequence[tuple]) -> DataFrame:
    """The rows of the named versions (day, digest): only their folders are listed and read."""
    days = spark.read.option("basePath", f"{path}/days").parquet(*[f"{path}/days/ev_date={day}/sha256={sha}" for day, sha in versions])
    return days.withColumn("ev_date", F.col("ev_date").cast("date")).withColumn("sha256", F.col("sha256").cast("string"))


def current_days(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the manifest's latest row of each day names."""
    latest = _read(spark, f"{path}/manifest", MANIFEST).groupBy("ev_date").agg(F.max_by("sha256", "load").alias("sha256"))
    return _days(spark, path, [tuple(row) for row in latest.collect()])


def day_changes(spark: SparkSession, path: str) -> DataFrame:
    """The change log of all loads."""
    return _read(spark, f"{path}/changes", "change_kind string, ev_date date, id_voter string, county string, voting_method string, old_sha256 string, new_sha256 string, load string")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder's rows; none where it doesn't exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_appearances(stream: DataFrame, small: int = SMALL) -> DataFrame:
    """STR03: a stream of first appearances per voter, each replacing the one before. ``change``, where the stream has
    it, is ``removed`` for appearances that a re-published day takes back.

    State is a voter's appearances (day, row_hash, occ) with how often each is there, so that when the first one
    goes the next one takes its place; a voter without any is given with nulls. Additions and removals may come in any
    order. There is no watermark: the horizon is the whole election.

    Each call to the state store is a round trip, so up to ``small`` appearances are one value, read and written once
    for a voter and batch; only a voter of more has a map, so that no value grows without bound."""

    class FirstAppearance(StatefulProcessor):  # local, so that it reaches the state's worker by value
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.few = handle.getValueState("few", "large boolean, day array<int>, row_hash array<long>, occ array<int>, n array<int>")
            self.first = handle.getValueState("first", "day int, row_hash long, occ int")
            self.seen = handle.getMapState("seen", "day int, row_hash long, occ int", "n int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import pandas as pd

            deltas: dict[tuple, int] = {}
            for batch in rows:
                ats = zip(*(batch[c].tolist() for c in ("day", "row_hash", "occ")), strict=True)
                for at, change in zip(ats, batch["change"].tolist(), strict=True):
                    deltas[at] = deltas.get(at, 0) + (-1 if change == "removed" else 1)
            stored = self.few.get() or (False, [], [], [], [])
            best, least = self.in_map(deltas) if stored[0] else self.in_value(stored, deltas)
            if least != best:
                yield pd.DataFrame({"id_voter": [key[0]], **{c: pd.array([None if least is None else least[k]], dtype=t) for k, (c, t) in enumerate((("day", "Int32"), ("row_hash", "Int64"), ("occ", "Int32")))}})

        def in_value(self, stored: tuple, deltas: dict[tuple, int]) -> tuple:
            """The first appearances before and after these changes."""
            seen = dict(zip(zip(*stored[1:4], strict=True), stored[4], strict=True))
            best = min((at for at, n in seen.items() if n > 0), default=None)
            for at, delta in deltas.items():
                seen[at] = seen.get(at, 0) + delta
            seen = {at: n for at, n in seen.items() if n}
            least = min((at for at, n in seen.items() if n > 0), default=None)
            if len(seen) <= small:
                columns = zip(*seen, strict=True) if seen else ((), (), ())
                self.few.update((False, *map(list, columns), list(seen.values())))
            else:
                for at, n in seen.items():
                    self.seen.updateValue(at, (n,))
                if least is not None:
                    self.first.update(least)
                self.few.update((True, [], [], [], []))
            return best, least

        def in_map(self, deltas: dict[tuple, int]) -> tuple:
            best = tuple(self.first.get()) if self.first.exists() else None
            least = best
            for at, delta in deltas.items():
                n = delta + (self.seen.getValue(at)[0] if self.seen.containsKey(at) else 0)
                if n:
                    self.seen.updateValue(at, (n,))
                elif self.seen.containsKey(at):
                    self.seen.removeKey(at)
                if n > 0 and (least is None or at < least):
                    least = at
                elif n <= 0 and at == least:
                    least = min((tuple(k) for k, v in self.seen.iterator() if v[0] > 0), default=None)
            if least is None:
                self.first.clear()
            elif least != best:
                self.first.update(least)
            return best, least

        def close(self) -> None:
            pass

    change = F.col("change") if "change" in stream.columns else F.lit("added")
    rows = stream.select("id_voter", "day", "row_hash", "occ", change.alias("change"))
    return rows.groupBy("id_voter").transformWithStateInPandas(statefulProcessor=FirstAppearance(), outputStructType="id_voter string, day int, row_hash long, occ int", outputMode="Update", timeMode="None")


def streaming_day_series(stream: DataFrame) -> DataFrame:
    """Totals per day of all rows so far, for ``complete`` output."""
    return by_day_series(stream)
