"""Roster rows: validation, occurrence numbers, duplicate flags, deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import appearance_token, day_number, row_hash, zfill
from tallyframe.workers import cut_lineage

#: Ranges of row hashes (2 ** bits) within a day that are ranked apart.
SLICE_BITS = 6
#: Order of a voter's appearances: day, then hash, then occurrence.
APPEARANCE = ("day", "row_hash", "occ")


def split_known_and_extra(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """PRJ02: the known columns, and a map ``extra`` of the others' texts (empty ones too)."""
    rest = [c for c in df.columns if c not in known]
    extra = F.create_map(*[x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]) if rest else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return df.select(*known, extra.alias("extra"))


def checked(df: DataFrame) -> DataFrame:
    """PRJ01: ``df`` with cleaned county, voter_name, id_voter, voting_method and ``errors``, an array of
    field:kind that never holds values. Blank counties and names, ids that aren't 1 to 10 ASCII digits and
    methods outside the two are errors; ``_cells`` and ``_expected``, where present (``readers.read_day_lines``), must
    agree, and where they don't that is the only error."""
    text = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in ("county", "voter_name", "id_voter", "voting_method")}
    method = F.upper(text["voting_method"])
    problems = [
        F.when(text["county"] == "", "county:blank"),
        F.when(text["voter_name"] == "", "voter_name:blank"),
        F.when(~F.rlike(text["id_voter"], F.lit("^[0-9]{1,10}$")), "id_voter:digits"),
        F.when(~method.isin("IN-PERSON", "MAIL-IN"), "voting_method:unknown"),
    ]
    if "_cells" in df.columns:
        whole = F.col("_cells") == F.col("_expected")
        problems = [F.when(~whole, "column_count"), *[F.when(whole, p) for p in problems]]
    clean = {"county": text["county"], "voter_name": text["voter_name"], "id_voter": zfill(text["id_voter"], 10), "voting_method": method}
    out = df.withColumn("errors", F.array_compact(F.array(*problems)))
    good = F.size("errors") == 0
    return out.withColumns({c: F.when(good, x).otherwise(F.col(c)) for c, x in clean.items()})


def validate_roster_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRJ01: (rows, rejects). Rejects keep the whole raw row as a map, the cells beyond the header (overflow) and
    the reason. Of a line with too few cells the map has those that are there."""
    helpers = ("_cells", "_expected", "_raw", "_overflow")
    marked = checked(df)
    rows = marked.where(F.size("errors") == 0).drop("errors", *helpers)
    # the cells as they came: ``checked`` leaves rejected rows alone
    raw = F.create_map(*[x for c in df.columns if c not in helpers for x in (F.lit(c), F.col(c).cast("string"))])
    raw = F.coalesce("_raw", raw) if "_raw" in df.columns else raw
    overflow = F.col("_overflow") if "_overflow" in df.columns else F.array().cast("array<string>")
    rejects = marked.where(F.size("errors") > 0).select(raw.alias("raw"), overflow.alias("overflow"), F.array_join("errors", ",").alias("reason"))
    return rows, rejects


def canonical_rows(df: DataFrame, content: Sequence[str] = ("county", "voter_name", "id_voter", "voting_method", "precinct")) -> DataFrame:
    """Day number, content hash and occurrence number of each row of a day (``ev_date``)."""
    hashed = df.withColumn("day", day_number("ev_date")).withColumn("row_hash", row_hash(content))
    return occurrence_number(hashed)


def occurrence_number(df: DataFrame) -> DataFrame:
    """WIN04: ``occ`` counts a day's rows of one hash from 0. They are identical, so any order does."""
    return df.withColumn("occ", F.row_number().over(Window.partitionBy("day", "row_hash").orderBy(F.lit(0))) - 1)


def first_appearance_rank(df: DataFrame, key: str = "id_voter", order: Sequence[str] = APPEARANCE) -> DataFrame:
    """WIN03: ``rank`` 1 for a voter's first appearance.

    Ranks in two levels, so that a voter with very many rows is ranked by several tasks: a slice is a voter's rows of
    one value of the first column of ``order`` (the day) and one range of the second (a 64-bit hash); the rows
    before a slice are a running sum over a voter's slices, and a window ranks inside it."""
    first, second = order[0], order[1]
    numeric = df.schema[second].dataType.typeName() == "long"
    slices = F.shiftright(second, 64 - SLICE_BITS) if numeric else F.lit(0).cast("long")
    rows = df.withColumn("__slice", slices)
    by = [key, first, "__slice"]
    counts = rows.groupBy(*by).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(key).orderBy(first, "__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate(by)], F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*order[1:]))
    same = [F.col(c).eqNullSafe(F.col(f"__{k}")) for k, c in enumerate(by)]
    return rows.withColumn("__inside", inside).join(starts, same).select(*df.columns, (F.col("__start") + F.col("__inside")).cast("int").alias("rank"))


def ordinal(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """TOP05: ``df`` with each row's place, from 1, in the order of all rows; equal ones in any order.

    Rows are dealt by ranges, sorted and numbered where they are; ranges start where those before them end. The ranges
    are written once, so that a task that runs again sees the same ones."""
    ranges = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("__id", F.monotonically_increasing_id())
    ranges = ranges.withColumn("__range", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND((1 << 33) - 1))
    upto = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranges.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"))
    return ranges.join(F.broadcast(starts), "__range").select(*df.columns, (F.col("__start") + F.col("__at") + 1).alias(name))


def first_row(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DED02: the first row of each key, by a grouped minimum that combines before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*key, *[F.col("__row")[c].alias(c) for c in rest])


def last_row(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DED01, DED05: the last row of each key."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*key, *[F.col("__row")[c].alias(c) for c in rest])


def first_and_extra(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """DED03: the first row of each key, and a one-row frame with the number of ``extra`` rows."""
    return first_row(df, key, order), df.agg((F.count("*") - F.count_distinct(F.struct(*key))).alias("extra"))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """DED04: keys that occur more than once, with their number; a caller refuses to write where it has rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def insert_or_ignore(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """DED06: the rows of ``new`` whose key isn't stored, once each."""
    return new.dropDuplicates(list(key)).join(stored.select(*key), list(key), "left_anti").select(*new.columns)


def flag_duplicates(df: DataFrame, pos: Sequence[str] = ("pos",)) -> DataFrame:
    """WIN05: duplicate_flag, duplicate_type and also_found_on of each appearance.

    A voter with several dates, methods, counties, names or precincts has the flags of that, in this order;
    also_found_on names every other appearance's county and date once, in order of ``pos``. What is gathered per
    voter is its distinct counties and dates (tokens), each with its first two positions, not its rows; the text of a
    token's rows is made once for the token (and once for the first of them), not for each row."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    kinds = {"multiple_dates": "report_date", "conflicting_method": "voting_method", "multiple_counties": "county", "name_mismatch": "voter_name", "precinct_mismatch": "precinct"}
    flags = F.array_compact(F.array(*[F.when(F.min(blank(c)) != F.max(blank(c)), k) for k, c in kinds.items()]))
    found = df.groupBy("id_voter").agg(flags.alias("__flags"))
    row, token = F.struct(*pos), appearance_token("county", "report_date")
    nth = F.row_number().over(Window.partitionBy("id_voter", "token").orderBy("at"))
    firsts = df.select("id_voter", token.alias("token"), row.alias("at")).withColumn("nth", nth).where("nth <= 2")
    tokens = firsts.groupBy("id_voter", "token").agg(F.min("at").alias("first"), F.max(F.when(F.col("nth") == 2, F.col("at"))).alias("second"))
    tokens = tokens.groupBy("id_voter").agg(F.collect_list(F.struct("token", "first", "second")).alias("all"))
    tokens = tokens.join(found, "id_voter").select("id_voter", "__flags", "all", F.explode("all").alias("own"))
    own = F.col("own")

    def listed(first: bool) -> Column:
        """The others' tokens; a row's own one stands where another row has it first."""
        others = F.filter("all", lambda x: (x["token"] != own["token"]) | x["second"].isNotNull())
        placed = F.transform(others, lambda x: F.struct((F.when(x["token"] == own["token"], x["second"]).otherwise(x["first"]) if first else x["first"]).alias("at"), x["token"].alias("token")))
        return F.array_join(F.transform(F.sort_array(placed), lambda x: x["token"]), "; ")

    texts = tokens.select("id_voter", "__flags", F.col("own.token").alias("__token"), F.col("own.first").alias("__first"), listed(True).alias("__if_first"), listed(False).alias("__if_later"))
    out = df.withColumn("__token", token).withColumn("__at", row).join(texts, ["id_voter", "__token"], "left")
    also = F.when(F.col("__at") == F.col("__first"), F.col("__if_first")).otherwise(F.col("__if_later"))
    flag, kind = F.coalesce(F.size("__flags") > 0, F.lit(False)), F.coalesce(F.array_join("__flags", ","), F.lit(""))
    return out.select(*df.columns, flag.alias("duplicate_flag"), kind.alias("duplicate_type"), F.coalesce(also, F.lit("")).alias("also_found_on"))


def multi_place_flags(df: DataFrame) -> DataFrame:
    """WIN06: id_voter, and whether a later listing names another county, or another county or precinct,
    than the first (day, row_hash, occ).

    Some listing differs from the first one just where the least and the greatest place differ (nulls are places
    too), so no order within a voter is needed."""
    several = lambda *c: F.min(F.struct(*c)) != F.max(F.struct(*c))
    return df.groupBy("id_voter").agg(several("county").alias("multi_county"), several("county", "precinct").alias("multi_place"))


def union_days(frames: Sequence[DataFrame]) -> DataFrame:
    """SET01: all rows of all frames; columns that one lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """PRJ12: rule and n, the rows that break it, in one pass."""
    counts = df.agg(*[F.count_if(F.coalesce(rule, F.lit(False)) == False).alias(name) for name, rule in rules.items()])  # noqa: E712
    return counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("n")) for name in rules])).alias("x")).select("x.rule", "x.n")
