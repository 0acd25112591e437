"""Files and payloads as frames (SRC01-SRC14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import schemas
from tallyframe.functions.scalars import normalize_vuid, parse_method, zfill

_TRUE = ("true", "1", "yes")


def text_csv(spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None, multiline: bool = False) -> DataFrame:
    """A CSV of texts only; nothing is inferred, so the file is read once."""
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", "PERMISSIVE")
    if header:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
    return reader.csv(path if isinstance(path, str) else list(path))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_roster_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC01: roster rows of ten columns; a missing column, or a method that isn't one of the two, is an error."""
    raw = require_columns(text_csv(spark, path), schemas.ROSTER_CSV)
    method = F.upper(F.trim("voting_method"))
    return raw.select(
        zfill(F.trim("id_voter"), 10).alias("id_voter"),
        F.when(method.isin("IN-PERSON", "MAIL-IN"), method).otherwise(F.raise_error(F.lit("unknown voting method"))).alias("voting_method"),
        "precinct", "county", "election_id", F.to_date("report_date").alias("report_date"), "voter_name",
        F.lower("duplicate_flag").isin(*_TRUE).alias("duplicate_flag"), F.coalesce("duplicate_type", F.lit("")).alias("duplicate_type"), F.coalesce("also_found_on", F.lit("")).alias("also_found_on"),
    )


def read_day_roster(spark: SparkSession, path: str) -> DataFrame:
    """SRC02: a statewide day file. Header cells are trimmed and upper-cased, a byte-order mark goes,
    COUNTY_NAME counts as COUNTY and PRECINCT may be absent; repeated header cells are an error."""
    raw = text_csv(spark, path, multiline=True)
    names = [c.lstrip("﻿").strip().upper() for c in raw.columns]
    names = ["COUNTY" if c == "COUNTY_NAME" else c for c in names]
    if len(set(names)) < len(names):
        raise ValueError("repeated header cells")
    out = require_columns(raw.toDF(*names), schemas.DAY_ROSTER[:4])
    if "PRECINCT" not in names:
        out = out.withColumn("PRECINCT", F.lit(""))
    return out.toDF(*[c.lower() for c in out.columns])


def cells_of(line: Column) -> Column:
    """The cells of one CSV line; quotes around a cell go, doubled ones in it become one."""
    # every match takes a comma, so that empty cells are found too
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(raw, lambda c: F.when(F.startswith(c, F.lit('"')), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c))


def marked_csv(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """A CSV's columns as texts, and ``_line``: a line whose cells aren't as many as the header's, else null."""
    header = text_csv(spark, path, multiline=multiline).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, "_line")])
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
    return reader.schema(schema).csv(path if isinstance(path, str) else list(path))


def read_day_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC02 for files with lines of too few or too many cells, which ``validate_roster_rows`` rejects as column_count.

    Columns as ``read_day_roster``, and _expected (cells of the header), _cells (of the line), _raw (of a bad line, the
    cells that have a name, by name) and _overflow (its cells beyond the header)."""
    raw = marked_csv(spark, path, multiline=True)
    names = [c.lstrip("\ufeff").strip().upper() for c in raw.columns[:-1]]
    names = ["COUNTY" if c == "COUNTY_NAME" else c for c in names]
    if len(set(names)) < len(names):
        raise ValueError("repeated header cells")
    names = [c.lower() for c in names]
    require_columns(raw.toDF(*[c.upper() for c in names], "_line"), schemas.DAY_ROSTER[:4])
    out = raw.toDF(*names, "_line").withColumn("__cells", F.when(F.col("_line").isNotNull(), cells_of(F.regexp_replace("_line", "[\\r\\n]+$", ""))))
    n, width = F.size("__cells"), len(names)
    there = F.least(n, F.lit(width))
    kept = F.map_from_arrays(F.slice(F.array(*[F.lit(c) for c in names]), F.lit(1), there), F.slice("__cells", F.lit(1), there))
    bad = F.col("__cells").isNotNull()
    out = out.withColumns(
        {
            "_expected": F.lit(width),
            "_cells": F.when(bad, n).otherwise(width),
            "_raw": F.when(bad, kept),
            "_overflow": F.when(bad & (n > width), F.slice("__cells", F.lit(width + 1), n)).otherwise(F.array().cast("array<string>")),
        }
    ).drop("_line", "__cells")
    return out if "precinct" in names else out.withColumn("precinct", F.lit(""))


def read_turnout_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC03: published counts, typed; an empty county_id is null."""
    raw = text_csv(spark, path)
    columns = []
    for name, kind in schemas.TURNOUT_CSV.items():
        text = F.nullif(F.trim(name), F.lit(""))
        columns.append((F.lower(F.trim(name)).isin(*_TRUE) if kind == "boolean" else text.try_cast(kind)).alias(name))
    return raw.select(*columns)


def load_stored_turnout(spark: SparkSession, folder: str, dates: Sequence[str] = ()) -> DataFrame:
    """SRC04: turnout files of a folder; with ``dates`` those whose name has one of them, or no date."""
    out = read_turnout_csv(spark, f"{folder}/turnout_*.csv").withColumn("__day", F.regexp_extract(F.input_file_name(), r"/turnout_[^/]*?(\d{4}-\d{2}-\d{2})", 1))
    return (out.where(F.col("__day").isin("", *dates)) if dates else out).drop("__day")


def turnout_from_json(df: DataFrame, column: str = "payload") -> DataFrame:
    """SRC05: county rows of turnout payloads. roster_available: the report field is a text or true."""
    parsed = df.select(F.from_json(column, schemas.TURNOUT_JSON).alias("p")).select("p.election_id", "p.early_voting_date", F.explode("p.turnout_by_county").alias("r"))
    report = F.col("r.voter_details_report")
    return parsed.select("election_id", "early_voting_date", F.trim("r.name").alias("county"), F.col("r.id").alias("county_id"), "r.registered_voters", F.col("r.in_person_votes_on_date").alias("in_person_on_date"), F.col("r.total_in_person_votes_for_election").alias("in_person"), F.col("r.total_mail_votes_for_election").alias("mail_in"), (report.isNotNull() & (F.lower(report) != "false") & (report != "")).alias("roster_available"))


def elections_from_json(df: DataFrame, column: str = "payload") -> DataFrame:
    """SRC06: elections with their dates (MM/DD/YYYY) and counties as arrays."""
    e = df.select(F.explode(F.from_json(column, schemas.ELECTIONS_JSON)["elections"]).alias("e"))
    day = lambda x: F.try_to_date(x, "MM/dd/yyyy")
    dates = F.transform("e.early_voting_dates", lambda d: F.struct(day(d["date"]).alias("date"), d["date_turnout_id"].alias("id")))
    return e.select("e.id", "e.type", day(F.col("e.election_date")).alias("election_date"), "e.election_name", "e.certified", dates.alias("early_dates"), F.col("e.counties").alias("counties"))


def decode_envelope(df: DataFrame, column: str = "body") -> DataFrame:
    """SRC07: ``payload`` of ``{"upload": base64}`` bodies; an empty body is empty; a bad one is null with
    ``error`` set, and fails nothing else."""
    upload = F.get_json_object(column, "$.upload")
    raw = F.try_to_binary(upload, F.lit("base64"))
    empty = F.trim(F.coalesce(F.col(column), F.lit(""))) == ""
    return df.withColumn("payload", F.when(empty, "").otherwise(F.decode(raw, "UTF-8"))).withColumn("error", F.when(~empty & raw.isNull(), "bad_envelope"))


def decode_sections(df: DataFrame, column: str = "body") -> DataFrame:
    """SRC08: section and json of a document whose values, but for Version, are base64 JSON; a bad section
    is {} and leaves the others alone."""
    sections = df.select(*[c for c in df.columns if c != column], F.explode(F.from_json(column, "map<string,string>")).alias("section", "raw")).where("section != 'Version'")
    text = F.decode(F.try_to_binary("raw", F.lit("base64")), "UTF-8")
    return sections.withColumn("json", F.coalesce(F.to_json(F.try_parse_json(text)), F.lit("{}"))).drop("raw")


def election_refs(df: DataFrame, column: str = "payload", years: tuple[int, int] | None = None, kinds: Sequence[str] = (), archive: bool = False, max_items: int | None = None) -> DataFrame:
    """SRC09, TOP02: year, kind, election_id, name from the year -> kind -> id tree.

    Years that aren't digits pass a window. The live feed's id is its ID field; the archive's falls back to
    the key. Archive: ascending; live: newest first, ``max_items`` at most."""
    tree = df.select(F.explode(F.from_json(column, schemas.CONSTANTS_JSON)["electionInfo"]).alias("year", "kinds"))
    leaf = tree.select("year", F.explode("kinds").alias("kind", "ids")).select("year", "kind", F.explode("ids").alias("key", "e"))
    out = leaf.select("year", "kind", F.coalesce(F.col("e.ID"), F.col("key") if archive else F.lit(None)).alias("election_id"), F.col("e.N").alias("name")).where("election_id is not null")
    number = F.when(F.rlike("year", F.lit("^[0-9]+$")), F.col("year").cast("int"))
    if years:
        out = out.where(number.isNull() | number.between(*years))
    if kinds:
        out = out.where(F.col("kind").isin(*kinds))
    by_id = F.col("election_id").try_cast("long")
    out = out.orderBy("year", by_id) if archive else out.orderBy(F.desc("year"), by_id.desc())
    return out.limit(max_items) if max_items is not None else out


def race_results(df: DataFrame, column: str = "payload") -> DataFrame:
    """SRC10: race_id, race, candidate, party, votes, early votes."""
    race = df.select(F.explode(F.from_json(column, schemas.OFFICE_JSON)["OS"]).alias("r"))
    return race.select(F.col("r.OID").alias("race_id"), F.col("r.ON").alias("race"), F.explode("r.C").alias("c")).select("race_id", "race", F.col("c.N").alias("candidate"), F.col("c.P").alias("party"), F.col("c.T").alias("votes"), F.col("c.O").alias("other_votes"))


def county_results(df: DataFrame, column: str = "payload") -> DataFrame:
    """SRC10: fips, county, race_id, candidate, votes, early votes; a county without detail has nulls."""
    county = df.select(F.explode(F.from_json(column, schemas.COUNTY_JSON)).alias("fips", "d"))
    race = county.select("fips", F.col("d.N").alias("county"), F.col("d.Summary.RV").alias("registered"), F.explode_outer("d.Races").alias("race_id", "r"))
    return race.select("fips", "county", "registered", "race_id", F.explode_outer("r.C").alias("cid", "c")).select("fips", "county", "registered", "race_id", F.col("c.N").alias("candidate"), F.col("c.V").alias("votes"), F.col("c.EV").alias("early_votes"))


def unzip_rosters(spark: SparkSession, folder: str, max_bytes: int = 1 << 30) -> DataFrame:
    """SRC11: path, county, voter_name, id_voter, voting_method, precinct of the CSVs inside ZIP files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "content")
    return unzip_archives(spark, files, max_bytes)


def unzip_archives(spark: SparkSession, files: DataFrame, max_bytes: int = 1 << 30) -> DataFrame:
    """SRC11, for archives that are rows (path, content) already.

    Counties are trimmed and upper-cased, rows without one dropped; members beyond ``max_bytes`` are an
    error. Archives can't be split, so each is one row of a task, read line by line."""
    from tallyframe.workers import ship_package

    ship_package(spark)

    def rows(batches):
        import csv
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.infolist():
                        if not member.filename.lower().endswith(".csv"):
                            continue
                        if member.file_size > max_bytes:
                            raise ValueError("archive member too large")
                        with archive.open(member) as f:
                            part = []
                            for row in csv.DictReader(io.TextIOWrapper(f, "utf-8-sig", newline="")):
                                clean = {(k or "").strip().upper(): v for k, v in row.items() if k}
                                county = (clean.get("COUNTY") or clean.get("COUNTY_NAME") or "").strip().upper()
                                if county:
                                    part.append((path, county, *(clean.get(c) for c in ("VOTER_NAME", "ID_VOTER", "VOTING_METHOD", "PRECINCT"))))
                                if len(part) == 10_000:
                                    yield pd.DataFrame(part, columns=["path", "county", "voter_name", "id_voter", "voting_method", "precinct"])
                                    part = []
                            yield pd.DataFrame(part, columns=["path", "county", "voter_name", "id_voter", "voting_method", "precinct"])

    return files.mapInPandas(rows, "path string, county string, voter_name string, id_voter string, voting_method string, precinct string")


def read_county_rosters(spark: SparkSession, files: Sequence[str], county: Column, ev_date: Column, drop_blank_ids: bool = True) -> DataFrame:
    """SRC12: per-county files of four columns; ``county`` and ``ev_date`` are expressions over __path."""
    raw = text_csv(spark, files).withColumn("__path", F.input_file_name())
    out = raw.select(county.alias("county"), ev_date.alias("ev_date"), F.col("VOTER_NAME").alias("voter_name"), normalize_vuid("ID_VOTER").alias("id_voter"), parse_method("VOTING_METHOD").alias("voting_method"), F.col("PRECINCT").alias("precinct"))
    return out.where("id_voter != ''") if drop_blank_ids else out


def read_register(spark: SparkSession, path: str, columns: Sequence[str], targets: DataFrame | None = None, id_column: str = "VUID") -> DataFrame:
    """SRC13: the chosen columns of a wide register, of the targets (id_voter) if given. Lines that don't parse (another
    number of cells than the header's) are left out; ``register_bad_rows`` counts them."""
    out = marked_csv(spark, path).where("_line is null").select(*columns)
    if targets is None:
        return out
    ids = targets.select(normalize_vuid("id_voter").alias("__id")).distinct()
    return out.withColumn("__id", normalize_vuid(id_column)).join(ids, "__id", "left_semi").drop("__id")


def register_bad_rows(spark: SparkSession, path: str, id_column: str = "VUID") -> DataFrame:
    """SRC13: in one row n_rows, n_bad (lines that don't parse) and n_blank_ids of a register."""
    blank = F.trim(F.coalesce(F.col(id_column), F.lit(""))) == ""
    rows = marked_csv(spark, path).select("_line", id_column)
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("_line").isNotNull()).alias("n_bad"), F.count_if(F.col("_line").isNull() & blank).alias("n_blank_ids"))


def read_geo(df: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC14: areas, precincts, and the areas that break a rule: all four edges of a box or none, the box
    in order, the point inside it."""
    parsed = df.select(F.from_json(column, schemas.GEO_JSON).alias("g"))
    areas = parsed.select(F.explode("g.areas").alias("a")).select("a.*")
    edges = ("south", "west", "north", "east")
    known = sum((F.col(c).isNotNull().cast("int") for c in edges), F.lit(0))
    inside = F.col("lat").between(F.col("south"), F.col("north")) & F.col("lon").between(F.col("west"), F.col("east"))
    problem = F.when(~known.isin(0, 4), "box").when((known == 4) & ~F.coalesce(inside, F.lit(False)), "point")
    return areas, parsed.select(F.explode("g.precincts").alias("p")).select("p.*"), areas.withColumn("problem", problem).where("problem is not null")


def election_of_path(path: Column | str) -> Column:
    """PRJ13: the election id in a file's name or folder."""
    path = F.col(path) if isinstance(path, str) else path
    name = F.regexp_extract(path, r"_(\d+)\.[A-Za-z]+$", 1)
    return F.when(name != "", name).otherwise(F.nullif(F.regexp_extract(path, r"/(\d+)/[^/]*$", 1), F.lit("")))
