"""The library's queries over the driver's tables, each with SQL of the same rows where SQL can say it."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.operators import aggregates as A
from tallyframe.operators import changes as C
from tallyframe.operators import distinct as D
from tallyframe.operators import geo as G
from tallyframe.operators import quality as Q
from tallyframe.operators import register as R
from tallyframe.operators import roster as O
from tallyframe.operators import versions as V
from tallyframe.plans.series import day_series
from tallyframe.sources import adapters as T
from tallyframe.sources import readers as I
from tallyframe.sources import sinks as K
from tallyframe.sources import stored as SD
from tallyframe.streaming.ingest import current_days, day_changes, day_files, first_appearances, ingest_days, publish_load, streaming_day_series
from tallyframe.workers import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query under its function's name, and its SQL after the views' WITH clause."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"{T.with_views(*views)} {sql}" if views else sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    """A new folder for files that a query writes and reads back."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4()}"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.keyed(T.roster(spark, sf_dir))


COUNTS = "count(*) FILTER (WHERE method = 'in_person') AS in_person, count(*) FILTER (WHERE method = 'mail_in') AS mail_in, count(*) AS total"
FIRST = "first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_key) AS n FROM roster) WHERE n = 1)"


# ---------------------------------------------------------------- the by-day series


@query(
    f""", {FIRST}, days AS (SELECT ev_date, {COUNTS} FROM roster WHERE method IS NOT NULL GROUP BY ev_date),
    new AS (SELECT ev_date, count(*) AS new_voters, count(*) FILTER (WHERE method = 'in_person') AS new_in_person, count(*) FILTER (WHERE method = 'mail_in') AS new_mail_in FROM first WHERE method IS NOT NULL GROUP BY ev_date)
    SELECT d.ev_date, in_person, mail_in, total, CAST(sum(in_person) OVER w AS BIGINT) AS cumulative_in_person, CAST(sum(mail_in) OVER w AS BIGINT) AS cumulative_mail_in, CAST(sum(total) OVER w AS BIGINT) AS cumulative_total,
      new_voters, new_in_person, new_mail_in, CASE WHEN new_voters IS NOT NULL THEN greatest(total - new_voters, 0) END AS restated_rows,
      CASE WHEN bool_or(new_voters IS NULL) OVER w THEN NULL ELSE CAST(sum(new_voters) OVER w AS BIGINT) END AS cumulative_unique_voters
    FROM days d LEFT JOIN new n ON d.ev_date = n.ev_date WINDOW w AS (ORDER BY d.ev_date ROWS UNBOUNDED PRECEDING)""",
    ("roster",),
)
def day_series_with_unique_voters(spark, sf_dir):
    return day_series(_keyed(spark, sf_dir))


@query(
    f""", days AS (SELECT ev_date, {COUNTS} FROM roster_big WHERE method IS NOT NULL GROUP BY ev_date)
    SELECT ev_date, in_person, mail_in, total, CAST(sum(in_person) OVER w AS BIGINT) AS cumulative_in_person, CAST(sum(mail_in) OVER w AS BIGINT) AS cumulative_mail_in, CAST(sum(total) OVER w AS BIGINT) AS cumulative_total
    FROM days WINDOW w AS (ORDER BY ev_date ROWS UNBOUNDED PRECEDING)""",
    ("roster_big",),
)
def win01_running_totals_big(spark, sf_dir):
    return A.running_totals(A.by_day_series(T.roster_big(spark, sf_dir)))


# ---------------------------------------------------------------- sources


def _roster_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.flag_duplicates(T.clean_roster(spark, sf_dir))
    return rows.withColumn("election_id", F.lit("e1"))


ROSTER_FILE = """, v AS (SELECT id_voter, count(DISTINCT report_date) > 1 OR count(DISTINCT voting_method) > 1 OR count(DISTINCT county) > 1 OR count(DISTINCT voter_name) > 1 OR count(DISTINCT precinct) > 1 AS flagged FROM clean GROUP BY id_voter)"""


@query(f"{ROSTER_FILE} SELECT c.id_voter, voting_method, precinct, county, 'e1' AS election_id, report_date, voter_name, flagged AS duplicate_flag FROM clean c JOIN v ON c.id_voter = v.id_voter", ("roster", "clean"))
def src01_roster_csv(spark, sf_dir):
    """SRC01 and SNK01: the roster with its duplicate flags, written as CSV and read back."""
    folder = _folder(spark)
    K.write_roster_csv(_roster_file(spark, sf_dir), folder)
    return I.read_roster_csv(spark, folder).drop("duplicate_type", "also_found_on")


@query(" SELECT county, voter_name, id_voter, voting_method, precinct FROM roster", ("roster",))
def src02_day_roster(spark, sf_dir):
    """A statewide file whose header is untidy, written as CSV and read back."""
    folder, r = _folder(spark), T.roster(spark, sf_dir)
    named = r.select(F.col("county").alias(" County_Name"), F.col("voter_name").alias("voter_name "), F.col("id_voter").alias("ID_VOTER"), F.col("voting_method").alias("Voting_Method"), F.col("precinct").alias("PRECINCT"))
    named.write.option("header", True).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return I.read_day_roster(spark, folder)


def _turnout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.turnout(spark, sf_dir)
    return t.select("election_id", F.lit("2024-01-30").cast("date").alias("report_date"), "county", F.when(F.col("county_id") != "3", F.col("county_id")).alias("county_id"), "registered_voters", F.lit(7).cast("long").alias("in_person_votes_on_date"), "total_in_person_votes", "total_mail_votes", (F.col("registered_voters") % 20 != 0).alias("roster_available"), F.lit("s, t").alias("source"))


TURNOUT_ROWS = " SELECT election_id, DATE '2024-01-30' AS report_date, county, CASE WHEN county_id <> '3' THEN county_id END AS county_id, registered_voters, CAST(7 AS BIGINT) AS in_person_votes_on_date, total_in_person_votes, total_mail_votes, registered_voters % 20 <> 0 AS roster_available, 's, t' AS source FROM turnout"


@query(TURNOUT_ROWS, ("roster", "clean", "turnout"))
def src03_turnout_csv(spark, sf_dir):
    """SRC03 and SNK03: published counts, written as CSV and read back."""
    folder = _folder(spark)
    K.write_turnout_csv(_turnout_rows(spark, sf_dir), folder)
    return I.read_turnout_csv(spark, folder)


@query(f", t AS ({TURNOUT_ROWS}) SELECT * FROM t UNION ALL SELECT * REPLACE ('all' AS source) FROM t", ("roster", "clean", "turnout"))
def src04_stored_turnout(spark, sf_dir):
    """Files of two days and one without a day; one day and the one without are asked for."""
    folder, rows = _folder(spark), _turnout_rows(spark, sf_dir)
    for name, source in (("2024-01-30", "s, t"), ("2024-01-31", "other"), ("all", "all")):
        K.write_turnout_csv(rows.withColumn("source", F.lit(source)), f"{folder}/turnout_{name}.csv")
    return I.load_stored_turnout(spark, folder, ["2024-01-30"])


@query(" SELECT upper(county) AS county, voter_name, id_voter, voting_method, precinct FROM roster WHERE row_key % 40 <> 0", ("roster",))
def src11_unzip_rosters(spark, sf_dir):
    """The roster as ZIP archives, one per part of it, made by tasks and read back; rows of a blank county go."""
    folder, r = _folder(spark), T.roster(spark, sf_dir)
    county = F.when(F.col("row_key") % 40 == 0, " ").otherwise(F.concat(F.lit(" "), F.lower("county")))
    lines = r.select(F.to_csv(F.struct(county.alias("county"), "voter_name", "id_voter", "voting_method", "precinct"), {"quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("line"))

    def zipped(batches):
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("day.csv", "\n".join(["COUNTY,VOTER_NAME,ID_VOTER,VOTING_METHOD,PRECINCT", *batch["line"]]))
                archive.writestr("readme.txt", "no roster")
            yield pd.DataFrame({"content": [packed.getvalue()]})

    archives = lines.mapInPandas(zipped, "content binary").withColumn("path", F.concat(F.lit(f"{folder}/"), F.uuid(), F.lit(".zip")))
    archives.write.parquet(f"{folder}/archives")
    return I.unzip_archives(spark, spark.read.parquet(f"{folder}/archives")).drop("path")


@query(" SELECT county, ev_date, voter_name, id_voter, CASE method WHEN 'mail_in' THEN 'MAIL-IN' ELSE 'IN-PERSON' END AS voting_method, precinct FROM roster WHERE id_voter <> '0000000003'", ("roster",))
def src12_county_rosters(spark, sf_dir):
    """Files per county and day, whose folders name both; a blank id is dropped."""
    folder, r = _folder(spark), T.roster(spark, sf_dir)
    ids = F.when(F.col("id_voter") == "0000000003", " ").otherwise(F.regexp_replace("id_voter", "^0+", ""))
    method = F.when(F.upper("voting_method").like("%MAIL%"), "by mail").otherwise("in person")
    rows = r.select("county", "ev_date", F.col("voter_name").alias("VOTER_NAME"), ids.alias("ID_VOTER"), method.alias("VOTING_METHOD"), F.col("precinct").alias("PRECINCT"))
    rows.where("ID_VOTER != ''").unionByName(rows.where("ID_VOTER = ''").withColumn("ID_VOTER", F.lit("0"))).repartition("county", "ev_date").write.partitionBy("county", "ev_date").option("header", True).csv(folder)
    county = F.regexp_replace(F.regexp_extract("__path", "county=([^/]+)/", 1), "%20", " ")
    day = F.to_date(F.regexp_extract("__path", "ev_date=([0-9-]+)/", 1))
    return I.read_county_rosters(spark, [folder], county, day)


@query(" SELECT VUID, SEX, DOB FROM register WHERE lpad(VUID, 10, '0') IN (SELECT id_voter FROM roster)", ("roster", "register"))
def src13_read_register(spark, sf_dir):
    """The register as a wide CSV, of which the targets' rows and three columns are read back."""
    folder = _folder(spark)
    T.register(spark, sf_dir).drop("pos").write.option("header", True).csv(folder)
    return I.read_register(spark, folder, ["VUID", "SEX", "DOB"], T.roster(spark, sf_dir)).withColumn("SEX", F.coalesce("SEX", F.lit("")))


@query(" SELECT count(*) AS n_rows, count(*) FILTER (pos % 7 = 0 OR pos % 11 = 1) AS n_bad, count(*) FILTER (pos % 7 <> 0 AND pos % 11 <> 1 AND pos % 5 = 0) AS n_blank_ids FROM register", ("register",))
def src13_register_bad_rows(spark, sf_dir):
    """A register with lines that lack a cell or have one more, and blank ids."""
    folder, header = _folder(spark), "VUID,SEX,DOB"
    rows = T.register(spark, sf_dir)
    pos = F.col("pos")
    line = F.when(pos % 7 == 0, F.concat_ws(",", "VUID", "SEX")).when(pos % 11 == 1, F.concat_ws(",", "VUID", "SEX", "DOB", F.lit("more")))
    line = F.coalesce(line, F.concat_ws(",", F.when(pos % 5 == 0, F.lit(" ")).otherwise(F.col("VUID")), "SEX", "DOB"))
    rows.select(line.alias(header)).write.option("header", True).option("quote", "").option("sep", "\u0001").csv(folder)
    return I.register_bad_rows(spark, folder)


@query(
    """, n AS (SELECT county, county_id, registered_voters, total_in_person_votes AS in_person, total_mail_votes AS mail_in, registered_voters % 20 <> 0 AS roster_available FROM turnout)
    SELECT 'e1' AS election_id, '2024-01-30' AS early_voting_date, county, county_id, registered_voters, CAST(0 AS BIGINT) AS in_person_on_date, in_person, mail_in, roster_available FROM n""",
    ("roster", "clean", "turnout"),
)
def src05_turnout_from_json(spark, sf_dir):
    return I.turnout_from_json(_turnout_payload(spark, sf_dir))


def _turnout_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.turnout(spark, sf_dir)
    report = F.when(F.col("registered_voters") % 20 != 0, "report.csv").otherwise("false")
    row = F.struct(F.col("county").alias("name"), F.col("county_id").alias("id"), "registered_voters", F.lit(0).alias("in_person_votes_on_date"), F.col("total_in_person_votes").alias("total_in_person_votes_for_election"), F.col("total_mail_votes").alias("total_mail_votes_for_election"), report.alias("voter_details_report"))
    # one payload per county stands for captured responses
    return t.select(F.to_json(F.struct(F.lit("e1").alias("election_id"), F.lit("2024-01-30").alias("early_voting_date"), F.array(row).alias("turnout_by_county"))).alias("payload"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS type, CAST(o_orderdate AS DATE) AS election_date, 'name ' || CAST(o_orderkey AS VARCHAR) AS election_name, o_orderkey % 2 = 0 AS certified, CAST(CAST(o_orderdate AS DATE) - 5 AS VARCHAR) || ',' || CAST(CAST(o_orderdate AS DATE) - 4 AS VARCHAR) AS early_dates, 'A,B' AS counties FROM orders")
def src06_elections_from_json(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    day = lambda n: F.date_format(F.date_add("d", n), "MM/dd/yyyy")
    dates = F.array(*[F.struct(day(n).alias("date"), F.lit(str(i)).alias("date_turnout_id")) for i, n in enumerate((-5, -4))])
    counties = F.array(*[F.struct(F.lit(str(i)).alias("county_id"), F.lit(c).alias("name")) for i, c in enumerate("AB")])
    e = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("type"), day(0).alias("election_date"), F.concat(F.lit("name "), F.col("o_orderkey").cast("string")).alias("election_name"), (F.col("o_orderkey") % 2 == 0).alias("certified"), dates.alias("early_voting_dates"), counties.alias("counties"))
    parsed = I.elections_from_json(o.select(F.to_json(F.struct(F.array(e).alias("elections"))).alias("payload")))
    return parsed.withColumn("early_dates", F.array_join(F.transform("early_dates", lambda x: F.date_format(x["date"], "yyyy-MM-dd")), ",")).withColumn("counties", F.array_join(F.transform("counties", lambda x: x["name"]), ","))


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 10 = 1 THEN NULL ELSE props END AS payload, CASE WHEN event_id % 10 = 1 THEN 'bad_envelope' END AS error FROM events")
def src07_decode_envelope(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 10 == 0, "").when(F.col("event_id") % 10 == 1, '{"upload": "!!"}').otherwise(F.to_json(F.struct(F.base64(F.encode("props", "UTF-8")).alias("upload"))))
    return I.decode_envelope(e.select("event_id", body.alias("body"))).drop("body")


@query("""SELECT event_id, s AS section, CASE WHEN s = 'Bad' THEN '{}' ELSE '{"k":' || regexp_extract(props, '[0-9]+') || '}' END AS json FROM events, (VALUES ('Good'), ('Bad')) v(s)""")
def src08_decode_sections(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.lit("7").alias("Version"), F.base64(F.encode("props", "UTF-8")).alias("Good"), F.lit("!!").alias("Bad")))
    return I.decode_sections(e.select("event_id", body.alias("body")))


@query("SELECT CAST(1990 + o_orderkey % 20 AS VARCHAR) AS year, o_orderstatus AS kind, CAST(o_orderkey AS VARCHAR) AS election_id, o_orderpriority AS name FROM orders WHERE 1990 + o_orderkey % 20 BETWEEN 1995 AND 2005 AND o_orderstatus IN ('F', 'O')")
def src09_election_refs(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    leaf = F.create_map(F.col("o_orderkey").cast("string"), F.struct(F.col("o_orderkey").cast("string").alias("ID"), F.col("o_orderpriority").alias("N")))
    tree = F.create_map((1990 + F.col("o_orderkey") % 20).cast("string"), F.create_map("o_orderstatus", leaf))
    return I.election_refs(o.select(F.to_json(F.struct(tree.alias("electionInfo"))).alias("payload")), years=(1995, 2005), kinds=("F", "O"), archive=True)


@query("SELECT CAST(1990 + o_orderkey % 20 AS VARCHAR) AS year, o_orderstatus AS kind, CAST(o_orderkey AS VARCHAR) AS election_id, o_orderpriority AS name FROM orders ORDER BY year DESC, o_orderkey DESC LIMIT 25")
def top02_newest_elections(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    leaf = F.create_map(F.lit("x"), F.struct(F.col("o_orderkey").cast("string").alias("ID"), F.col("o_orderpriority").alias("N")))
    tree = F.create_map((1990 + F.col("o_orderkey") % 20).cast("string"), F.create_map("o_orderstatus", leaf))
    return I.election_refs(o.select(F.to_json(F.struct(tree.alias("electionInfo"))).alias("payload")), max_items=25)


@query("SELECT CAST(l_orderkey AS VARCHAR) AS race_id, 'race' AS race, CAST(l_linenumber AS VARCHAR) AS candidate, l_returnflag AS party, CAST(l_quantity AS BIGINT) AS votes, CAST(l_linenumber AS BIGINT) AS other_votes FROM lineitem")
def src10_race_results(spark, sf_dir):
    lines = T.table(spark, sf_dir, "lineitem")
    c = F.struct(F.col("l_linenumber").cast("string").alias("N"), F.col("l_returnflag").alias("P"), F.col("l_quantity").cast("long").alias("T"), F.col("l_linenumber").cast("long").alias("O"))
    race = F.struct(F.col("l_orderkey").cast("string").alias("OID"), F.lit("race").alias("ON"), F.array(c).alias("C"))
    return I.race_results(lines.select(F.to_json(F.struct(F.array(race).alias("OS"))).alias("payload")))


@query("SELECT CAST(c_custkey AS VARCHAR) AS fips, c_name AS county, CAST(c_custkey * 10 AS BIGINT) AS registered, CASE WHEN c_custkey % 5 <> 0 THEN 'r1' END AS race_id, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS candidate, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS votes, CAST(CASE WHEN c_custkey % 5 <> 0 THEN 1 END AS BIGINT) AS early_votes FROM customer")
def src10_county_results(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer")
    candidate = F.create_map(F.lit("1"), F.struct(F.col("c_mktsegment").alias("N"), F.col("c_custkey").alias("V"), F.lit(1).alias("EV")))
    races = F.when(F.col("c_custkey") % 5 != 0, F.create_map(F.lit("r1"), F.struct(candidate.alias("C"))))
    detail = F.create_map(F.col("c_custkey").cast("string"), F.struct(F.col("c_name").alias("N"), F.struct((F.col("c_custkey") * 10).alias("RV")).alias("Summary"), races.alias("Races")))
    return I.county_results(c.select(F.to_json(detail).alias("payload")))


@query("SELECT VUID, SEX, DOB FROM register WHERE lpad(VUID, 10, '0') IN (SELECT id_voter FROM roster)", ("roster", "register"))
def jon02_target_filter(spark, sf_dir):
    return R.target_filter(T.register(spark, sf_dir), T.roster(spark, sf_dir), "VUID").select("VUID", "SEX", "DOB")


@query("SELECT CAST(p_partkey AS VARCHAR) AS code, CASE WHEN p_partkey % 4 = 0 THEN 'box' ELSE 'point' END AS problem FROM part WHERE p_partkey % 4 = 0 OR p_partkey % 4 = 1")
def src14_read_geo(spark, sf_dir):
    p = T.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    edge = lambda v: F.lit(float(v))
    area = F.struct(F.lit("precinct").alias("kind"), k.cast("string").alias("code"), F.when(k % 4 == 1, 9.0).otherwise(0.5).alias("lat"), F.lit(0.5).alias("lon"), edge(0).alias("south"), edge(0).alias("west"), edge(1).alias("north"), F.when(k % 4 != 0, edge(1)).alias("east"))
    _, _, bad = I.read_geo(p.select(F.to_json(F.struct(F.array(area).alias("areas"))).alias("payload")))
    return bad.select("code", "problem")


@query(None)
def prj13_election_of_path(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    path = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/d/"), F.col("o_orderkey").cast("string"), F.lit("/x.csv"))).otherwise(F.concat(F.lit("/d/roster_"), F.col("o_orderkey").cast("string"), F.lit(".csv")))
    return o.select("o_orderkey", I.election_of_path(path).alias("election_id"))


ORACLES["prj13_election_of_path"] = "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS election_id FROM orders"


# ---------------------------------------------------------------- projections and validation


@query(
    """, x AS (SELECT row_key, concat_ws(',', CASE WHEN row_key % 31 = 0 THEN 'county:blank' END, CASE WHEN row_key % 37 = 0 THEN 'id_voter:digits' END,
      CASE WHEN upper(trim(voting_method)) NOT IN ('IN-PERSON', 'MAIL-IN') THEN 'voting_method:unknown' END) AS reason FROM roster)
    SELECT reason, count(*) AS n FROM x GROUP BY reason""",
    ("roster",),
)
def prj01_validate_roster_rows(spark, sf_dir):
    rows = T.roster(spark, sf_dir).withColumn("county", F.when(F.col("row_key") % 31 == 0, "  ").otherwise(F.col("county"))).withColumn("id_voter", F.when(F.col("row_key") % 37 == 0, "12x").otherwise(F.col("id_voter")))
    good, bad = O.validate_roster_rows(rows)
    return good.select(F.lit("").alias("reason")).union(bad.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    """, x AS (SELECT *, CASE WHEN row_key % 13 = 0 THEN 'short' WHEN row_key % 17 = 0 THEN 'long' ELSE 'whole' END AS kind FROM roster)
    SELECT row_key, CASE WHEN kind <> 'whole' THEN 'column_count' ELSE 'voting_method:unknown' END AS reason,
      CASE WHEN kind = 'short' THEN county || '|' || voter_name || '|' || id_voter ELSE county || '|' || voter_name || '|' || id_voter || '|' || voting_method || '|' || CAST(row_key AS VARCHAR) END AS cells,
      CASE WHEN kind = 'long' THEN 'a "b", c|' || precinct ELSE '' END AS overflow
    FROM x WHERE kind <> 'whole' OR upper(trim(voting_method)) NOT IN ('IN-PERSON', 'MAIL-IN')""",
    ("roster",),
)
def prj01_dirty_day_file(spark, sf_dir):
    """A day's CSV of which some lines lack cells and some have more: the rejects with their cells and overflow."""
    folder = _folder(spark)
    rows = T.roster(spark, sf_dir)
    key, quoted = F.col("row_key").cast("string"), F.lit('"a ""b"", c"')
    whole = F.concat_ws(",", "county", "voter_name", "id_voter", F.concat(F.lit('"'), F.col("voting_method"), F.lit('"')), key)
    # a short line can't hold its number as a cell, so its name does
    line = F.when(F.col("row_key") % 13 == 0, F.concat_ws(",", "county", F.concat_ws(" ", "voter_name", key), "id_voter")).when(F.col("row_key") % 17 == 0, F.concat_ws(",", whole, quoted, "precinct")).otherwise(whole)
    rows.select(line.alias("COUNTY,VOTER_NAME,ID_VOTER,VOTING_METHOD,PRECINCT")).write.option("header", True).option("quote", "").option("sep", "\u0001").csv(folder)
    _, bad = O.validate_roster_rows(I.read_day_lines(spark, folder))
    name = F.col("raw")["voter_name"]
    number = F.coalesce(F.col("raw")["precinct"], F.regexp_extract(name, "([0-9]+)$", 1)).cast("long")
    plain = F.when(F.size("raw") == 3, F.regexp_replace(name, " [0-9]+$", "")).otherwise(name)
    cells = F.concat_ws("|", F.col("raw")["county"], plain, F.col("raw")["id_voter"], F.col("raw")["voting_method"], F.col("raw")["precinct"])
    return bad.select(number.alias("row_key"), "reason", cells.alias("cells"), F.array_join("overflow", "|").alias("overflow"))


@query("""SELECT event_id, '{"event_type":"' || event_type || '","user_id":"' || CAST(user_id AS VARCHAR) || '"}' AS extra FROM events""")
def prj02_known_and_extra(spark, sf_dir):
    e = T.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return O.split_known_and_extra(e, ["event_id"]).withColumn("extra", F.to_json("extra"))


def _parse_sql() -> str:
    from tallyframe.schemas import HISTORY

    cells = [f"nullif(trim({h}), '')" for h in HISTORY]
    voted = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cells)
    return f"""SELECT lpad(VUID, 10, '0') AS vuid, SEX AS sex, TRY_CAST(strptime(DOB, '%Y%m%d') AS DATE) AS dob, CASE WHEN c13 THEN NULL ELSE DATE '2010-02-03' END AS edr,
      CASE WHEN c13 THEN 2 ELSE 0 END AS flags, {voted} AS n_cells FROM (SELECT *, EDR = '18991231' AS c13 FROM register) WHERE SEX IN ('F', 'M', 'U')"""


@query(_parse_sql(), ("register",))
def prj03_parse_voter(spark, sf_dir):
    from functools import reduce

    from tallyframe.schemas import HISTORY

    voters, _ = R.parse_voter(T.register(spark, sf_dir), "2026-11-03")
    voted = reduce(lambda a, b: a + b, [F.col(h.lower()).isNotNull().cast("int") for h in HISTORY])
    return voters.select("vuid", "sex", "dob", "edr", "flags", voted.alias("n_cells"))


@query("SELECT lpad(VUID, 10, '0') AS vuid, CASE WHEN SEX = '' THEN 'sex:blank' ELSE 'sex:code' END AS reason FROM register WHERE SEX NOT IN ('F', 'M', 'U')", ("register",))
def prj03_voter_rejects(spark, sf_dir):
    return R.parse_voter(T.register(spark, sf_dir), "2026-11-03")[1]


def _versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as versioned rows: each is added at 1 to 3 and, sometimes, removed one to two later."""
    lines = T.table(spark, sf_dir, "lineitem")
    added = (F.col("l_partkey") % 3 + 1).cast("int")
    removed = F.when(F.col("l_suppkey") % 3 == 0, added + (F.col("l_linenumber") % 2 + 1).cast("int"))
    return lines.select(F.col("l_orderkey").alias("day"), F.col("l_partkey").alias("row_hash"), F.col("l_linenumber").alias("occ"), added.alias("added_in"), removed.alias("removed_in"))


VERSIONED = """WITH versioned AS (SELECT l_orderkey AS day, l_partkey AS row_hash, l_linenumber AS occ, CAST(l_partkey % 3 + 1 AS INTEGER) AS added_in,
  CAST(CASE WHEN l_suppkey % 3 = 0 THEN l_partkey % 3 + 1 + l_linenumber % 2 + 1 END AS INTEGER) AS removed_in FROM lineitem)"""


@query(f"{VERSIONED} SELECT * FROM versioned WHERE removed_in IS NULL")
def prj04_live_rows(spark, sf_dir):
    return V.live_rows(_versioned(spark, sf_dir))


@query(f"{VERSIONED} SELECT * FROM versioned WHERE added_in <= 2 AND (removed_in IS NULL OR removed_in > 2)")
def prj05_visible_at(spark, sf_dir):
    return V.visible_at(_versioned(spark, sf_dir), 2)


@query(f", t AS (SELECT ev_date, upper(trim(county)) AS county, {COUNTS} FROM roster WHERE method IS NOT NULL GROUP BY ALL) SELECT ev_date, county, in_person, mail_in FROM t", ("roster",))
def prj06_method_slice(spark, sf_dir):
    return A.method_slice(A.county_by_day(T.roster(spark, sf_dir)))


@query("SELECT o_orderkey, regexp_matches(lpad(CAST(o_orderkey % 100 AS VARCHAR), 6, '0'), '^[0-9]+$') AND o_orderkey % 100 <> 0 AS valid FROM orders")
def prj07_valid_election_id(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.valid_election_id(F.lpad((F.col("o_orderkey") % 100).cast("string"), 6, "0")).alias("valid"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'roster' ELSE 'turnout' END AS kind FROM events")
def prj08_payload_kind(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    return e.select("event_id", S.payload_kind(F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("COUNTY,"), "props")).otherwise(F.concat(F.lit(" "), "props"))).alias("kind"))


def _calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    return o.select(F.col("o_orderkey").cast("string").alias("election_id"), F.col("d").alias("election_date"), F.array(F.date_add("d", -3), F.date_add("d", -2)).alias("dates"))


CALENDAR_DAYS = """WITH cal AS (SELECT CAST(o_orderkey AS VARCHAR) AS election_id, CAST(o_orderdate AS DATE) AS d FROM orders), planned AS (
  SELECT election_id, d + k AS ev_date, CASE WHEN k = 0 THEN 'election_day' ELSE 'early' END AS period FROM cal, (VALUES (-3), (-2), (0)) v(k) WHERE d + k <= DATE '1998-06-01')"""


@query(f"{CALENDAR_DAYS} SELECT * FROM planned")
def prj09_plan_load_days(spark, sf_dir):
    return V.plan_load_days(_calendar_days(spark, sf_dir), "1998-06-01")


@query(f"{CALENDAR_DAYS} SELECT election_id, max(ev_date) AS ev_date FROM planned WHERE (datediff('day', DATE '1970-01-01', ev_date)) % 4 <> 0 GROUP BY election_id")
def prj10_latest_loadable_day(spark, sf_dir):
    days = V.plan_load_days(_calendar_days(spark, sf_dir), "1998-06-01")
    counts = days.select("election_id", "ev_date", F.pmod(F.datediff("ev_date", F.lit("1970-01-01").cast("date")), F.lit(4)).alias("n"))
    return V.latest_loadable_day(days, counts)


@query(
    """, n AS (SELECT ev_date, count(*) AS n FROM roster GROUP BY ev_date), x AS (SELECT ev_date, n, day(ev_date) % 4 AS m FROM n)
    SELECT ev_date, CASE WHEN m = 0 THEN 'failed' WHEN m = 1 THEN 'unchanged' WHEN m = 2 THEN 'skipped_empty' ELSE 'changed' END AS status, CASE WHEN m = 3 THEN 'new' ELSE 'old' END AS sha256 FROM x""",
    ("roster",),
)
def prj11_day_status(spark, sf_dir):
    days = T.roster(spark, sf_dir).groupBy("ev_date").agg(F.count("*").alias("n")).withColumn("m", F.dayofmonth("ev_date") % 4)
    new = days.select("ev_date", F.when(F.col("m") == 1, "old").otherwise("new").alias("sha256"), F.when(F.col("m") == 2, 0).otherwise(F.col("n")).alias("n_rows"), F.when(F.col("m") == 0, "timeout").alias("error"))
    return C.day_status(days.select("ev_date", F.lit("old").alias("sha256")), new)


@query("SELECT 'disc' AS rule, count(*) FILTER (WHERE l_discount > 0.05) AS n FROM lineitem UNION ALL SELECT 'qty', count(*) FILTER (WHERE NOT l_quantity > 10) FROM lineitem")
def prj12_violations(spark, sf_dir):
    return O.violations(T.table(spark, sf_dir, "lineitem"), {"disc": F.col("l_discount") <= 0.05, "qty": F.col("l_quantity") > 10})


@query("SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 48 HOUR")
def prj14_stale_elections(spark, sf_dir):
    index = T.table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("last_refreshed"), F.col("o_orderdate").alias("modified"))
    return V.stale_elections(index, "1998-01-01 00:00:00", 48).select("o_orderkey")


@query("SELECT county FROM turnout WHERE registered_voters % 20 <> 0", ("roster", "clean", "turnout"))
def prj15_counties_with_roster(spark, sf_dir):
    return I.turnout_from_json(_turnout_payload(spark, sf_dir)).where("roster_available").select("county")


# ---------------------------------------------------------------- joins

MATCH = """, reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lpad(VUID, 10, '0') ORDER BY pos) AS n FROM register) WHERE n = 1),
age AS (SELECT *, 2026 - year(strptime(DOB, '%Y%m%d')) - CAST('1103' < substr(DOB, 5, 4) AS INTEGER) AS age FROM reg),
enriched AS (SELECT c.row_key, c.id_voter, c.county, c.precinct, c.voting_method, VUID IS NOT NULL AS in_register, CD AS cd, HD AS hd, SD AS sd, a.COUNTY AS vf_county, PCT AS vf_precinct,
  CASE WHEN age < 18 THEN NULL WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44' WHEN age <= 54 THEN '45-54' WHEN age <= 64 THEN '55-64' WHEN age <= 74 THEN '65-74' ELSE CASE WHEN age IS NULL THEN NULL ELSE '75+' END END AS age_bracket,
  nullif(SEX, '') AS sex, nullif(HISPANIC, 'NULL') AS hispanic, STATUS AS status FROM clean c LEFT JOIN age a ON lpad(a.VUID, 10, '0') = c.id_voter)"""


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = T.register(spark, sf_dir)
    mapping = {f: c for f, (c, _) in S.detect_columns([c for c in register.columns if c != "pos"]).items()}
    return R.match_register(T.clean_roster(spark, sf_dir), register, mapping, "2026-11-03")


@query(f"{MATCH} SELECT * FROM enriched", ("roster", "clean", "register"))
def jon01_match_register(spark, sf_dir):
    return _enriched(spark, sf_dir).select("row_key", "id_voter", "county", "precinct", "voting_method", "in_register", "cd", "hd", "sd", "vf_county", "vf_precinct", "age_bracket", "sex", "hispanic", "status")


@query(
    f"""{MATCH}, long AS (SELECT unnest(['cd', 'hd', 'sd', 'county', 'age_bracket', 'sex', 'voting_method', 'hispanic']) AS dimension,
      unnest([cd, hd, sd, county, age_bracket, sex, voting_method, hispanic]) AS value FROM enriched WHERE in_register)
    SELECT dimension, coalesce(nullif(trim(value), ''), 'Unknown') AS value, count(*) AS n FROM long GROUP BY ALL""",
    ("roster", "clean", "register"),
)
def agg14_match_breakdowns(spark, sf_dir):
    return R.match_breakdowns(_enriched(spark, sf_dir))


@query(
    f"""{MATCH} SELECT count(*) AS total, count(*) FILTER (WHERE in_register) AS matched, count(*) FILTER (WHERE in_register AND upper(county) <> upper(vf_county)) AS county_mismatch,
      count(*) FILTER (WHERE in_register AND lpad(precinct, 4, '0') <> vf_precinct) AS precinct_mismatch, count(*) FILTER (WHERE NOT in_register) AS unmatched,
      count(*) FILTER (WHERE in_register) / count(*) AS match_rate FROM enriched""",
    ("roster", "clean", "register"),
)
def agg14_match_summary(spark, sf_dir):
    return R.match_summary(_enriched(spark, sf_dir))


GAPS = """, flags AS (SELECT county, id_voter, bool_or(voting_method = 'IN-PERSON') AS ip, bool_or(voting_method = 'MAIL-IN') AS mail FROM clean GROUP BY ALL),
by_county AS (SELECT county, count(*) FILTER (WHERE ip) AS roster_in_person, count(*) FILTER (WHERE mail AND NOT ip) AS roster_mail, count(*) AS roster_total FROM flags GROUP BY county),
sides AS (SELECT coalesce(t.county, r.county) AS county, county_id, CAST(coalesce(registered_voters, 0) AS BIGINT) AS registered_voters, coalesce(total_in_person_votes, 0) AS turnout_in_person, coalesce(total_mail_votes, 0) AS turnout_mail,
  coalesce(roster_in_person, 0) AS roster_in_person, coalesce(roster_mail, 0) AS roster_mail, coalesce(roster_total, 0) AS roster_total, coalesce(total_in_person_votes, 0) + coalesce(total_mail_votes, 0) AS turnout_total
  FROM turnout t FULL JOIN by_county r ON t.county = r.county),
gaps AS (SELECT *, turnout_in_person - roster_in_person AS gap_in_person, turnout_mail - roster_mail AS gap_mail, turnout_total - roster_total AS gap_total, CASE WHEN turnout_total <> 0 THEN (turnout_total - roster_total) / turnout_total ELSE 0.0 END AS gap_pct FROM sides)"""
_GAP_VIEWS = ("roster", "clean", "turnout")


@query(f"{GAPS} SELECT * FROM by_county", _GAP_VIEWS)
def agg12_roster_by_county(spark, sf_dir):
    return Q.roster_by_county(T.clean_roster(spark, sf_dir))


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gap_report(T.clean_roster(spark, sf_dir), T.turnout(spark, sf_dir))


@query(f"{GAPS} SELECT * FROM gaps", _GAP_VIEWS)
def agg13_gap_report(spark, sf_dir):
    return _gaps(spark, sf_dir)


_SUMS = ", ".join(f"CAST(sum({s}_{c}) AS BIGINT) AS {s}_{c}" for s in ("turnout", "roster", "gap") for c in ("in_person", "mail", "total"))


@query(f"{GAPS} SELECT {_SUMS}, count(*) FILTER (WHERE gap_total > 0) AS counties_with_gap, count(*) FILTER (WHERE gap_total < 0) AS counties_roster_over_turnout, sum(gap_total) / sum(turnout_total) AS gap_pct, (SELECT count(*) FROM clean) AS roster_rows, (SELECT count(DISTINCT id_voter) FROM clean) AS roster_unique FROM gaps", _GAP_VIEWS)
def agg13_gap_summary(spark, sf_dir):
    return Q.gap_summary(_gaps(spark, sf_dir), T.clean_roster(spark, sf_dir))


@query(f"{GAPS} SELECT county, gap_total FROM gaps WHERE gap_total > 0 ORDER BY gap_total DESC, county LIMIT 10", _GAP_VIEWS)
def top01_largest_gaps(spark, sf_dir):
    return Q.largest_gaps(_gaps(spark, sf_dir)).select("county", "gap_total")


@query(", t AS (SELECT lower(county) AS county, county_id FROM turnout UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR) FROM supplier) SELECT county, county_id FROM t WHERE upper(county) NOT IN (SELECT upper(county) FROM clean)", _GAP_VIEWS)
def jon04_missing_counties(spark, sf_dir):
    """Published counts that also name areas which no roster row has: suppliers stand for those."""
    areas = T.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("county"), F.col("s_suppkey").cast("string").alias("county_id"))
    published = T.turnout(spark, sf_dir).select(F.lower("county").alias("county"), "county_id").union(areas)
    return Q.missing_counties(T.clean_roster(spark, sf_dir), published).select("county", "county_id")


@query(", n AS (SELECT upper(county) AS k, count(*) AS n FROM clean GROUP BY 1) SELECT county, n, registered_voters, n - registered_voters AS excess FROM turnout JOIN n ON k = upper(county) WHERE registered_voters > 0 AND n > registered_voters", _GAP_VIEWS)
def jon05_turnout_anomaly(spark, sf_dir):
    return Q.turnout_anomaly(T.clean_roster(spark, sf_dir), T.turnout(spark, sf_dir))


@query(
    """, v AS (SELECT id_voter, count(*) AS n, count(DISTINCT report_date) AS d, count(DISTINCT voting_method) AS m, count(DISTINCT county) AS c, count(DISTINCT voter_name) AS w, count(DISTINCT precinct) AS p FROM clean GROUP BY id_voter),
    f AS (SELECT 'multiple_dates' AS finding_type, 'warning' AS severity, count(*) AS affected FROM v WHERE d > 1 UNION ALL SELECT 'duplicate_vuid', 'warning', count(*) FROM v WHERE n > 1
      UNION ALL SELECT 'conflicting_method', 'error', count(*) FROM v WHERE m > 1 UNION ALL SELECT 'multiple_counties', 'error', count(*) FROM v WHERE c > 1 UNION ALL SELECT 'name_mismatch', 'warning', count(*) FROM v WHERE w > 1
      UNION ALL SELECT 'precinct_mismatch', 'warning', count(*) FROM v WHERE p > 1), n AS (SELECT upper(county) AS k, count(*) AS n FROM clean GROUP BY 1)
    SELECT finding_type, severity, CAST(NULL AS VARCHAR) AS county, affected FROM f WHERE affected > 0 UNION ALL SELECT 'turnout_anomaly', 'warning', county, n - registered_voters FROM turnout JOIN n ON k = upper(county) WHERE registered_voters > 0 AND n > registered_voters
    UNION ALL SELECT 'missing_county', 'warning', county, 1 FROM turnout WHERE upper(county) NOT IN (SELECT k FROM n)""",
    _GAP_VIEWS,
)
def agg11_audit_findings(spark, sf_dir):
    return Q.audit_findings(T.clean_roster(spark, sf_dir), T.turnout(spark, sf_dir))


_TIERS = "(VALUES (18, 24, '18-24'), (25, 34, '25-34'), (35, 54, '35-54'), (55, 64, '55-64'), (65, 74, '65-74'), (75, 84, '75-84'), (85, 200, '85+')) {}(low, high, label)"


@query(
    f""", v AS (SELECT lpad(VUID, 10, '0') AS vuid, CAST(strptime(DOB, '%Y%m%d') AS DATE) AS dob FROM register WHERE SEX IN ('F', 'M', 'U')),
    a AS (SELECT vuid, CAST(2026 - year(dob) - CAST('0615' < strftime(dob, '%m%d') AS INTEGER) AS INTEGER) AS age_today, CAST(2026 - year(dob) - CAST('1103' < strftime(dob, '%m%d') AS INTEGER) AS INTEGER) AS age_election_day FROM v)
    SELECT vuid, age_today, age_election_day, t.label AS age_tier_today, e.label AS age_tier_election_day FROM a LEFT JOIN {_TIERS.format('t')} ON age_today BETWEEN t.low AND t.high LEFT JOIN {_TIERS.format('e')} ON age_election_day BETWEEN e.low AND e.high""",
    ("register",),
)
def jon06_age_tiers(spark, sf_dir):
    voters, _ = R.parse_voter(T.register(spark, sf_dir), "2026-11-03")
    return R.age_tiers(voters, R.calendar_frame(spark), "2026-06-15")


@query("SELECT c_custkey, DATE '2026-11-03' AS current_election FROM customer")
def jon07_current_election(spark, sf_dir):
    return R.with_current_election(T.table(spark, sf_dir, "customer").select("c_custkey"), R.calendar_frame(spark))


def _county_and_code() -> tuple:
    """Parts as precincts: 900 to a county, numbered in it, so that codes of four digits stay unique."""
    k = F.col("p_partkey")
    return F.lpad(F.floor(k / 900).cast("string"), 5, "0"), (k % 900).cast("string")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, (fips, c) = F.col("p_partkey"), _county_and_code()
    code = F.when(k % 50 == 7, k.cast("string")).when(k % 6 == 0, F.lpad(c, 4, "0")).when(k % 6 == 1, c).when(k % 6 == 2, F.concat(c, F.lit("a"))).when(k % 6 == 3, F.lit(" ")).when(k % 6 == 4, F.concat(F.lit(" "), c, F.lit(" "))).otherwise("zzz")
    return T.table(spark, sf_dir, "part").select(F.when(k % 50 != 7, fips).alias("county_fips"), code.alias("precinct"), F.lit(2).cast("long").alias("n"), k.alias("k"))


def _precincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, (fips, c) = F.col("p_partkey"), _county_and_code()
    prec = F.when(k % 6 == 2, F.upper(F.lpad(F.concat(c, F.lit("a")), 4, "0"))).otherwise(F.lpad(c, 4, "0"))
    return T.table(spark, sf_dir, "part").select(F.concat(F.lit("P"), k.cast("string")).alias("pctkey"), fips.alias("county_fips"), prec.alias("prec"), (k % 5).cast("string").alias("cd"), F.lit("9").alias("sd"), F.when(k % 7 != 0, "4").alias("hd"), (k % 9 == 0).alias("split_cd"), F.lit(False).alias("split_sd"), (k % 8 == 0).alias("split_hd"))


GEO = """WITH coded AS (SELECT p_partkey AS k, lpad(CAST(p_partkey // 900 AS VARCHAR), 5, '0') AS fips, CAST(p_partkey % 900 AS VARCHAR) AS c FROM part),
pairs AS (SELECT k, CASE WHEN k % 50 <> 7 THEN fips END AS county_fips,
  CASE WHEN k % 50 = 7 THEN CAST(k AS VARCHAR) ELSE CASE k % 6 WHEN 0 THEN lpad(c, 4, '0') WHEN 1 THEN c WHEN 2 THEN c || 'a' WHEN 3 THEN ' ' WHEN 4 THEN ' ' || c || ' ' ELSE 'zzz' END END AS precinct FROM coded),
resolved AS (SELECT *, CASE WHEN county_fips IS NULL OR k % 6 IN (3, 5) THEN NULL ELSE 'P' || CAST(k AS VARCHAR) END AS pctkey,
  CASE WHEN county_fips IS NULL OR k % 6 IN (3, 5) THEN 'unmatched' WHEN k % 6 = 0 THEN 'exact' WHEN k % 6 = 2 THEN 'alnum_zfill4' ELSE 'zfill4' END AS rule FROM pairs)"""


@query(f"{GEO} SELECT k, pctkey, rule FROM resolved")
def jon08_resolve_alias(spark, sf_dir):
    return G.resolve_alias(_pairs(spark, sf_dir), _precincts(spark, sf_dir)).select("k", "pctkey", "rule")


@query(
    f"""{GEO} SELECT rule, count(*) AS pairs, CAST(count(*) * 2 AS BIGINT) AS rows, count(pctkey) AS matched_pairs, count(pctkey) * 2 AS matched_rows, count(pctkey) / count(*) AS share FROM resolved GROUP BY rule
    UNION ALL SELECT 'all', count(*), count(*) * 2, count(pctkey), count(pctkey) * 2, count(pctkey) / count(*) FROM resolved"""
)
def agg17_alias_coverage(spark, sf_dir):
    return G.alias_coverage(G.resolve_alias(_pairs(spark, sf_dir), _precincts(spark, sf_dir)))


SOLE = """, prec AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS pctkey, lpad(CAST(p_partkey // 900 AS VARCHAR), 5, '0') AS county_fips, CAST(p_partkey % 5 AS VARCHAR) AS cd, '9' AS sd, CASE WHEN p_partkey % 7 <> 0 THEN '4' END AS hd,
  p_partkey % 9 = 0 AS split_cd, FALSE AS split_sd, p_partkey % 8 = 0 AS split_hd FROM part),
sole AS (SELECT county_fips, CASE WHEN count(DISTINCT coalesce(cd, '~')) = 1 AND NOT bool_or(split_cd) THEN max(cd) END AS sole_cd, CASE WHEN count(DISTINCT coalesce(sd, '~')) = 1 AND NOT bool_or(split_sd) THEN max(sd) END AS sole_sd,
  CASE WHEN count(DISTINCT coalesce(hd, '~')) = 1 AND NOT bool_or(split_hd) THEN max(hd) END AS sole_hd FROM prec GROUP BY county_fips)"""


@query(f"{GEO}{SOLE} SELECT * FROM sole")
def agg19_county_sole_districts(spark, sf_dir):
    return G.county_sole_districts(_precincts(spark, sf_dir))


PLACED = """, first_rows AS (SELECT lpad(CAST(k AS VARCHAR), 10, '0') AS id_voter, county_fips, precinct, k FROM pairs),
placed AS (SELECT id_voter, f.county_fips, r.pctkey, CASE WHEN r.pctkey IS NOT NULL THEN 'matched' WHEN f.k % 4 <> 0 THEN 'unmatched_alias' ELSE 'no_alias' END AS alias_state,
  CASE WHEN r.pctkey IS NOT NULL THEN p.cd ELSE s.sole_cd END AS cd, CASE WHEN r.pctkey IS NOT NULL THEN p.sd ELSE s.sole_sd END AS sd, CASE WHEN r.pctkey IS NOT NULL THEN p.hd ELSE s.sole_hd END AS hd,
  CASE WHEN r.pctkey IS NOT NULL THEN CAST(split_cd AS INTEGER) + 2 * CAST(split_sd AS INTEGER) + 4 * CAST(split_hd AS INTEGER) END AS split_flag
  FROM first_rows f LEFT JOIN (SELECT * FROM resolved WHERE k % 4 <> 0) r ON f.k = r.k LEFT JOIN prec p ON p.pctkey = r.pctkey LEFT JOIN sole s ON s.county_fips = f.county_fips)"""


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir).withColumn("precinct", F.when(F.col("k") % 6 == 3, F.concat(F.lit(" "), F.repeat(F.lit(" "), F.col("k").cast("int") % 97))).when(F.col("k") % 6 == 5, F.concat(F.lit("zzz"), F.col("k").cast("string"))).otherwise(F.col("precinct")))
    pairs = pairs.withColumn("precinct", F.when(F.col("k") % 6 == 3, F.concat(F.lit("?"), F.col("k").cast("string"))).otherwise(F.col("precinct")))
    pairs = pairs.withColumn("precinct", F.when(F.col("county_fips").isNull(), F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise(F.col("precinct")))
    resolved = G.resolve_alias(pairs.where("k % 4 != 0"), _precincts(spark, sf_dir))
    first = pairs.select(F.lpad(F.col("k").cast("string"), 10, "0").alias("id_voter"), "county_fips", "precinct")
    return G.place_voters(first, resolved, _precincts(spark, sf_dir))


@query(f"{GEO}{SOLE}{PLACED} SELECT * FROM placed")
def jon09_place_voters(spark, sf_dir):
    return _placed(spark, sf_dir)


@query(
    f"""{GEO}{SOLE}{PLACED} SELECT count(*) AS voters, count(*) FILTER (WHERE alias_state = 'matched') AS matched, count(*) FILTER (WHERE alias_state = 'unmatched_alias') AS unmatched_alias, count(*) FILTER (WHERE alias_state = 'no_alias') AS no_alias,
      count(*) FILTER (WHERE county_fips IS NULL) AS no_county, count(cd) AS with_cd, count(sd) AS with_sd, count(hd) AS with_hd, count(*) FILTER (WHERE pctkey IS NOT NULL AND cd IS NULL) AS null_cd, count(*) FILTER (WHERE pctkey IS NOT NULL AND sd IS NULL) AS null_sd,
      count(*) FILTER (WHERE pctkey IS NOT NULL AND hd IS NULL) AS null_hd, count(*) FILTER (WHERE split_flag & 1 > 0) AS split_cd, count(*) FILTER (WHERE split_flag & 2 > 0) AS split_sd, count(*) FILTER (WHERE split_flag & 4 > 0) AS split_hd FROM placed"""
)
def agg18_voter_geo_tally(spark, sf_dir):
    return G.voter_geo_tally(_placed(spark, sf_dir))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.where(k % 3 != 0).select(F.lpad(k.cast("string"), 10, "0").alias("id_voter"), F.when(k % 4 != 0, k.cast("string")).alias("pctkey"), F.lpad((k % 9).cast("string"), 3, "0").alias("cd"), (k % 4).cast("string").alias("sd"), F.when(k % 5 != 0, "1").alias("hd"), F.lit("2024-01-01").cast("date").alias("matched_at"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.where(k % 2 == 0).select(F.lpad(k.cast("string"), 10, "0").alias("id_voter"), F.when(k % 8 != 0, (k % 9).cast("string")).alias("cd"), (k % 3).cast("string").alias("sd"), F.lit("1").alias("hd"), F.lit("2024-02-01").cast("date").alias("matched_at"))


POINTS = """WITH geo AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS id_voter, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS pctkey, lpad(CAST(c_custkey % 9 AS VARCHAR), 3, '0') AS cd, CAST(c_custkey % 4 AS VARCHAR) AS sd, CASE WHEN c_custkey % 5 <> 0 THEN '1' END AS hd FROM customer WHERE c_custkey % 3 <> 0),
points AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS id_voter, CASE WHEN c_custkey % 8 <> 0 THEN CAST(c_custkey % 9 AS VARCHAR) END AS cd, CAST(c_custkey % 3 AS VARCHAR) AS sd, '1' AS hd, TRUE AS here FROM customer WHERE c_custkey % 2 = 0)"""


@query(
    f"""{POINTS}, ids AS (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS id_voter FROM orders)
    SELECT i.id_voter, CASE WHEN here THEN p.cd ELSE g.cd END AS cd, CASE WHEN here THEN p.sd ELSE g.sd END AS sd, CASE WHEN here THEN p.hd ELSE g.hd END AS hd, CASE WHEN here THEN DATE '2024-02-01' WHEN g.id_voter IS NOT NULL THEN DATE '2024-01-01' END AS matched_at
    FROM ids i LEFT JOIN geo g ON g.id_voter = i.id_voter LEFT JOIN points p ON p.id_voter = i.id_voter"""
)
def jon10_voter_geo_page(spark, sf_dir):
    day = T.table(spark, sf_dir, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("id_voter"))
    return G.voter_geo_page(day, _geo(spark, sf_dir), _points(spark, sf_dir))


def _outcome(x: str) -> str:
    return f"CASE WHEN here IS NULL THEN 'no_point' WHEN p.{x} IS NULL OR g.{x} IS NULL THEN 'not_comparable' WHEN ltrim(p.{x}, '0') = ltrim(g.{x}, '0') THEN 'agree' ELSE 'disagree' END"


@query(
    f"""{POINTS}, o AS ({' UNION ALL '.join(f"SELECT '{x}' AS layer, {_outcome(x)} AS outcome FROM geo g LEFT JOIN points p ON p.id_voter = g.id_voter WHERE pctkey IS NOT NULL" for x in ('cd', 'sd', 'hd'))})
    SELECT layer, count(*) FILTER (WHERE outcome = 'agree') AS agree, count(*) FILTER (WHERE outcome = 'disagree') AS disagree, count(*) FILTER (WHERE outcome = 'not_comparable') AS not_comparable, count(*) FILTER (WHERE outcome = 'no_point') AS no_point FROM o GROUP BY layer"""
)
def jon17_point_vs_precinct(spark, sf_dir):
    return G.point_vs_precinct(_points(spark, sf_dir), _geo(spark, sf_dir))


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    lat, lon = (k % 10 + 0.5).cast("double"), (k % 7 + 0.25).cast("double")
    return T.table(spark, sf_dir, "part").select(F.lit("precinct").alias("kind"), F.concat(F.lit("P"), k.cast("string")).alias("code"), lat.alias("lat"), lon.alias("lon"), (lat - 1).alias("south"), (lon - 1).alias("west"), (lat + 1).alias("north"), F.when(k % 3 != 0, lon + 1).alias("east"))


@query(f"{GEO} SELECT CAST(r.k AS VARCHAR) AS county, precinct, pctkey, CAST(k % 10 + 0.5 AS DOUBLE) AS lat, CAST(k % 7 + 0.25 AS DOUBLE) AS lon, k % 3 <> 0 AS has_box FROM resolved r WHERE pctkey IS NOT NULL")
def jon11_precinct_points(spark, sf_dir):
    resolved = G.resolve_alias(_pairs(spark, sf_dir), _precincts(spark, sf_dir)).withColumn("county", F.col("k").cast("string"))
    found, _ = G.precinct_points(resolved, _areas(spark, sf_dir))
    return found.select("county", "precinct", "pctkey", "lat", "lon", F.col("box").isNotNull().alias("has_box"))


@query(f"{GEO} SELECT CAST(k AS VARCHAR) AS county, precinct, pctkey FROM resolved WHERE pctkey IS NOT NULL ORDER BY 1, 2 LIMIT 100")
def top05_first_points(spark, sf_dir):
    """The first rows of the points in their output order, which is stable: by county, then precinct."""
    resolved = G.resolve_alias(_pairs(spark, sf_dir), _precincts(spark, sf_dir)).withColumn("county", F.col("k").cast("string"))
    found, _ = G.precinct_points(resolved, _areas(spark, sf_dir))
    return found.select("county", "precinct", "pctkey").limit(100)


@query(f"{GEO} SELECT CAST(k AS VARCHAR) AS county, precinct, pctkey, row_number() OVER (ORDER BY CAST(k AS VARCHAR), precinct, pctkey) AS place FROM resolved WHERE pctkey IS NOT NULL")
def top05_ordered_points(spark, sf_dir):
    """Every point with its place in the output order."""
    resolved = G.resolve_alias(_pairs(spark, sf_dir), _precincts(spark, sf_dir)).withColumn("county", F.col("k").cast("string"))
    found, _ = G.precinct_points(resolved, _areas(spark, sf_dir))
    return O.ordinal(found.select("county", "precinct", "pctkey"), [F.col("county"), F.col("precinct"), F.col("pctkey")])


@query(
    """WITH a AS (SELECT CAST(c_nationkey AS VARCHAR) AS county, CAST(c_custkey % 40 AS VARCHAR) AS house, min(c_custkey % 80) AS lo, max(c_custkey % 80) AS hi FROM customer GROUP BY ALL)
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS id_voter, county, CAST(lo AS DOUBLE) AS lat, CAST(1 AS DOUBLE) AS lon FROM customer JOIN a ON county = CAST(c_nationkey AS VARCHAR) AND house = CAST(c_custkey % 40 AS VARCHAR) WHERE lo = hi"""
)
def jon18_address_point_match(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    address = F.concat((k % 40).cast("string"), F.lit(" Main St"))
    addresses = c.select(F.col("c_nationkey").cast("string").alias("county"), F.concat(F.upper(address), F.lit(".")).alias("address"), (k % 80).cast("double").alias("lat"), F.lit(1.0).alias("lon"))
    voters = c.select(F.lpad(k.cast("string"), 10, "0").alias("id_voter"), F.col("c_nationkey").cast("string").alias("county"), F.concat(F.lit(" "), address).alias("address"))
    return G.address_point_match(voters, addresses)


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS id_voter, CAST(c_custkey % 10 AS INTEGER) AS district FROM customer WHERE (c_custkey * 7) % 100 < 50")
def jon19_point_in_polygon(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    points = c.select(F.lpad(k.cast("string"), 10, "0").alias("id_voter"), (k % 10 + 0.5).alias("lon"), ((k * 7) % 100 / 100.0).alias("lat"))
    corner = lambda x, y: F.struct((F.col("d") + x).cast("double").alias("x"), F.lit(float(y)).alias("y"))
    districts = T.table(spark, sf_dir, "nation").select((F.col("n_nationkey") % 10).alias("d")).distinct().select(F.col("d").alias("district"), F.array(corner(0, 0), corner(1, 0), corner(1, 0.5), corner(0, 0.5)).alias("ring"))
    return G.point_in_polygon(points, districts)


@query(
    """WITH o AS (SELECT l_orderkey AS precinct, CAST(l_suppkey AS INTEGER) AS district, max(l_quantity) AS area FROM lineitem GROUP BY ALL), t AS (SELECT precinct, max(area) AS top, sum(area) AS total FROM o GROUP BY precinct)
    SELECT o.precinct, min(district) AS district, round_even(least(1.0, max(top) / max(total)), 4) AS share, least(1.0, max(top) / max(total)) < 0.99 AS split FROM o JOIN t ON o.precinct = t.precinct WHERE area >= top * (1 - 1e-9) GROUP BY o.precinct"""
)
def jon20_largest_overlap(spark, sf_dir):
    overlaps = T.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("precinct"), F.col("l_suppkey").cast("string").alias("district")).agg(F.max("l_quantity").alias("area"))
    return G.largest_overlap(overlaps, overlaps.groupBy("precinct").agg(F.sum("area").alias("total")))


@query("SELECT c_custkey, CAST(n_nationkey AS VARCHAR) AS county_fips FROM customer JOIN nation ON c_nationkey = n_nationkey")
def jon21_county_name_join(spark, sf_dir):
    n = T.table(spark, sf_dir, "nation").select(F.translate("n_name", "0123456789", "ABCDEFGHIJ").alias("name"), F.col("n_nationkey").cast("string").alias("fips"))
    rows = T.table(spark, sf_dir, "customer").join(n, F.col("c_nationkey").cast("string") == F.col("fips")).select("c_custkey", F.concat(F.lit(" "), F.lower("name"), F.lit("-")).alias("county"))
    return G.county_name_join(rows, n).select("c_custkey", "county_fips")


@query("SELECT county, precinct, count(*) AS n FROM roster GROUP BY ALL", ("roster",))
def agg16_pair_counts(spark, sf_dir):
    return G.pair_counts(T.roster(spark, sf_dir))


@query(
    """WITH v AS (SELECT l_partkey AS code, min(l_quantity) AS s, max(l_quantity) AS n, min(l_extendedprice) AS w, max(l_extendedprice) AS e FROM lineitem GROUP BY 1)
    SELECT p_partkey AS code, round_even(least(s, CAST(p_size AS DOUBLE)), 6) AS south, round_even(least(w, p_retailprice), 6) AS west, round_even(greatest(n, CAST(p_size AS DOUBLE)), 6) AS north, round_even(greatest(e, p_retailprice), 6) AS east FROM part LEFT JOIN v ON code = p_partkey"""
)
def agg26_bounding_box(spark, sf_dir):
    vertices = T.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("code"), F.col("l_quantity").alias("lat"), F.col("l_extendedprice").alias("lon"))
    return G.bounding_box(vertices, T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), F.col("p_size").cast("double").alias("lat"), F.col("p_retailprice").alias("lon")))


@query(
    """WITH d AS (SELECT file_id, n_chunks, CAST(file_id % 3 AS VARCHAR) AS sha256 FROM (SELECT o_orderkey AS file_id, count(*) AS n_chunks FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1))
    SELECT file_id, sha256 FROM d WHERE file_id % 5 <> 0"""
)
def jon12_complete_days(spark, sf_dir):
    chunks = T.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file_id"))
    files = chunks.groupBy("file_id").agg(F.count("*").alias("n")).select("file_id", (F.col("file_id") % 3).cast("string").alias("sha256"), F.when(F.col("file_id") % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("n_chunks"))
    return V.complete_days(files.select("file_id", "sha256"), files, chunks)


@query(
    """WITH f AS (SELECT o_custkey AS election_id, o_orderkey AS file_id, CAST(o_orderkey % 2 AS VARCHAR) AS sha256, o_orderkey % 7 <> 0 AS complete FROM orders), p AS (SELECT o_custkey AS election_id, max(o_orderkey) AS file_id FROM orders GROUP BY 1),
    m AS (SELECT f.election_id, f.file_id, f.file_id = p.file_id AS own FROM f JOIN p ON f.election_id = p.election_id WHERE complete AND sha256 = '1')
    SELECT election_id, coalesce(max(CASE WHEN own THEN file_id END), min(file_id)) AS file_id, CASE WHEN bool_or(own) THEN 'pointer' ELSE 'matching' END AS how FROM m GROUP BY election_id"""
)
def jon13_choose_published(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    files = o.select(F.col("o_custkey").alias("election_id"), F.col("o_orderkey").alias("file_id"), (F.col("o_orderkey") % 2).cast("string").alias("sha256"), (F.col("o_orderkey") % 7 != 0).alias("complete"))
    pointers = o.groupBy(F.col("o_custkey").alias("election_id")).agg(F.max("o_orderkey").alias("file_id"), F.lit("1").alias("sha256"))
    return V.choose_published(pointers, files)


UNTIDY = """, untidy AS (SELECT 'a' AS side, id_voter, county, voting_method, pos FROM snap_prior UNION ALL SELECT 'b', id_voter, county, voting_method, pos FROM snap_current),
last AS (SELECT side, id_voter, CASE WHEN CAST(id_voter AS BIGINT) % 34 <> 3 THEN upper(trim(arg_max(county, pos))) ELSE '' END AS county, CASE WHEN CAST(id_voter AS BIGINT) % 34 <> 3 THEN upper(trim(arg_max(voting_method, pos))) ELSE '' END AS voting_method
  FROM untidy WHERE id_voter <> '0000000000' GROUP BY side, id_voter)"""


def _untidy(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """A snapshot with cells that have spaces and other cases, and voters without county and method."""
    rows, none = T.snapshot(spark, sf_dir, current), F.col("id_voter").cast("long") % 34 == 3
    return rows.withColumn("county", F.when(~none, F.concat(F.lit(" "), F.lower("county")))).withColumn("voting_method", F.when(~none, F.col("voting_method")))


@query(f"{UNTIDY} SELECT CASE side WHEN 'a' THEN 'removed' ELSE 'added' END AS change_kind, id_voter, county, voting_method FROM last l WHERE NOT EXISTS (SELECT 1 FROM last o WHERE o.id_voter = l.id_voter AND o.side <> l.side)", ("roster", "snap"))
def jon14_diff_rosters(spark, sf_dir):
    return C.diff_rosters(_untidy(spark, sf_dir, False), _untidy(spark, sf_dir, True))


COMPARED = """, p AS (SELECT id_voter, arg_min(county, pos) AS county, arg_min(voting_method, pos) AS method, list_sort(list(DISTINCT county)) AS counties, list_sort(list(DISTINCT voting_method)) AS methods FROM snap_prior GROUP BY 1),
c AS (SELECT id_voter, arg_min(county, pos) AS county, arg_min(voting_method, pos) AS method, list_sort(list(DISTINCT county)) AS counties, list_sort(list(DISTINCT voting_method)) AS methods, count(*) AS n FROM snap_current GROUP BY 1),
found AS (SELECT id_voter, 'within_file_dup' AS anomaly_kind, county, method AS voting_method, list_min(list_filter(counties, lambda x: x <> county)) AS prior_county, list_min(list_filter(methods, lambda x: x <> method)) AS prior_voting_method, n AS occurrence_count FROM c WHERE n > 1
 UNION ALL SELECT id_voter, 'dropped_from_later', NULL, NULL, county, method, 1 FROM p WHERE id_voter NOT IN (SELECT id_voter FROM c)
 UNION ALL SELECT c.id_voter, 'method_changed', c.county, c.method, p.county, p.method, 1 FROM c JOIN p ON c.id_voter = p.id_voter WHERE c.methods <> p.methods
 UNION ALL SELECT c.id_voter, 'county_changed', c.county, c.method, p.county, p.method, 1 FROM c JOIN p ON c.id_voter = p.id_voter WHERE c.counties <> p.counties)"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.compare_snapshots(T.snapshot(spark, sf_dir, False), T.snapshot(spark, sf_dir, True))


@query(f"{COMPARED} SELECT * FROM found", ("roster", "snap"))
def jon15_compare_snapshots(spark, sf_dir):
    return _compared(spark, sf_dir)


@query(
    f"""{COMPARED} SELECT DATE '2024-01-07' AS ev_date, count(DISTINCT id_voter) FILTER (WHERE anomaly_kind = 'within_file_dup') AS within_file_dup, count(DISTINCT id_voter) FILTER (WHERE anomaly_kind = 'dropped_from_later') AS dropped_from_later,
      count(DISTINCT id_voter) FILTER (WHERE anomaly_kind = 'method_changed') AS method_changed, count(DISTINCT id_voter) FILTER (WHERE anomaly_kind = 'county_changed') AS county_changed, CAST(coalesce(sum(occurrence_count - 1) FILTER (WHERE anomaly_kind = 'within_file_dup'), 0) AS BIGINT) AS excess_rows,
      count(*) FILTER (WHERE anomaly_kind = 'within_file_dup' AND prior_voting_method IS NOT NULL) AS multi_method, count(*) FILTER (WHERE anomaly_kind = 'within_file_dup' AND prior_county IS NOT NULL) AS multi_county FROM found""",
    ("roster", "snap"),
)
def agg15_anomaly_day_view(spark, sf_dir):
    return C.anomaly_day_view(_compared(spark, sf_dir).withColumn("ev_date", F.lit("2024-01-07").cast("date")))


@query(
    """, f AS (SELECT id_voter, CASE row_key % 3 WHEN 0 THEN 'GEN25' WHEN 1 THEN 'PRI26' ELSE 'RO26' END AS key, day(ev_date) AS early_day, row_key AS pos, CASE voting_method WHEN 'IN-PERSON' THEN 'E' ELSE 'A' END AS mode FROM clean),
    b AS (SELECT id_voter, key, arg_min(early_day, early_day * 1000000000 + pos) AS d, arg_min(mode, early_day * 1000000000 + pos) AS m FROM f GROUP BY ALL)
    SELECT id_voter AS id, CAST(max(d) FILTER (WHERE key = 'GEN25') AS INTEGER) AS gen25_day, max(m) FILTER (WHERE key = 'GEN25') AS gen25_mode, CAST(max(d) FILTER (WHERE key = 'PRI26') AS INTEGER) AS pri26_day, max(m) FILTER (WHERE key = 'PRI26') AS pri26_mode, CAST(max(d) FILTER (WHERE key = 'RO26') AS INTEGER) AS ro26_day, max(m) FILTER (WHERE key = 'RO26') AS ro26_mode FROM b GROUP BY id_voter""",
    ("roster", "clean"),
)
def jon16_dated_first_vote(spark, sf_dir):
    rows = T.clean_roster(spark, sf_dir)
    key = F.when(F.col("row_key") % 3 == 0, "GEN25").when(F.col("row_key") % 3 == 1, "PRI26").otherwise("RO26")
    return R.dated_first_vote(rows.withColumn("key", key).withColumn("early_day", F.dayofmonth("ev_date")), rows)


@query("SELECT CAST(o_orderkey AS INTEGER) AS id, 'E' || CAST(o_orderkey AS VARCHAR) AS key, CASE o_orderkey % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'election_date' WHEN 2 THEN 'early_days' ELSE 'first_early_date' END AS warning FROM orders WHERE o_orderkey % 7 < 4")
def jon22_check_calendar(spark, sf_dir):
    """Orders as elections, and a listing of their early days that misses, moves or lengthens some."""
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("int").alias("id"), F.to_date("o_orderdate").alias("d"))
    early = (F.col("id") % 4 + 1).cast("int")
    calendar = o.select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("key"), F.col("d").alias("election_date"), early.alias("early_days"), F.date_add("d", -10).alias("first_early_date"), F.array("id").alias("ids"))
    kind = F.col("id") % 7
    days = F.sequence(F.lit(0), early - 1 + F.when(kind == 2, 1).otherwise(0))
    shown = o.where(kind != 0).withColumn("n", F.explode(days))
    listed = shown.select("id", F.date_add("d", F.when(kind == 1, 1).otherwise(0)).alias("election_date"), F.date_add("d", F.col("n") - 10 + F.when(kind == 3, 1).otherwise(0)).alias("early_date"))
    return R.check_calendar(calendar, listed)


# ---------------------------------------------------------------- aggregates


@query(f", t AS (SELECT CAST(NULL AS VARCHAR) AS county, {COUNTS} FROM roster WHERE method IS NOT NULL UNION ALL SELECT upper(trim(county)), {COUNTS} FROM roster WHERE method IS NOT NULL GROUP BY 1) SELECT * FROM t", ("roster",))
def agg01_roster_totals(spark, sf_dir):
    return A.roster_totals(T.roster(spark, sf_dir))


@query(
    """ SELECT county, CAST(sum(total_in_person_votes) AS BIGINT) AS in_person, CAST(sum(total_mail_votes) AS BIGINT) AS mail_in, CAST(sum(total_in_person_votes + total_mail_votes) AS BIGINT) AS total FROM turnout WHERE registered_voters % 30 <> 0 GROUP BY GROUPING SETS ((county), ())""",
    ("roster", "clean", "turnout"),
)
def agg02_turnout_totals(spark, sf_dir):
    t = T.turnout(spark, sf_dir)
    name = F.when(F.col("registered_voters") % 30 == 0, " ").otherwise(F.concat(F.col("county"), F.lit(" ")))
    return A.turnout_totals(t.select(name.alias("county"), F.col("total_in_person_votes").alias("in_person"), F.col("total_mail_votes").alias("mail_in")))


@query(f" SELECT ev_date, {COUNTS} FROM roster_big WHERE method IS NOT NULL GROUP BY ev_date", ("roster_big",))
def agg03_by_day_series(spark, sf_dir):
    return A.by_day_series(T.roster_big(spark, sf_dir))


@query(f" SELECT ev_date, upper(county) AS county, {COUNTS} FROM roster_big WHERE method IS NOT NULL GROUP BY ALL", ("roster_big",))
def agg04_county_by_day(spark, sf_dir):
    return A.county_by_day(T.roster_big(spark, sf_dir))


@query(
    f""", t AS (SELECT ev_date, upper(trim(county)) AS county, {COUNTS}, CASE WHEN day(ev_date) % 2 = 0 THEN 'roster' ELSE 'turnout' END AS kind FROM roster WHERE method IS NOT NULL GROUP BY ev_date, 2)
    SELECT county, CAST(sum(in_person) AS BIGINT) AS in_person, CAST(sum(mail_in) AS BIGINT) AS mail_in, CAST(sum(total) AS BIGINT) AS total, array_to_string(list_sort(list(DISTINCT CAST(ev_date AS VARCHAR))), ',') AS days, max(ev_date) AS through,
      CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE 'mixed' END AS kind FROM t GROUP BY GROUPING SETS ((county), ())""",
    ("roster",),
)
def agg05_cumulative_totals(spark, sf_dir):
    days = A.county_by_day(T.roster(spark, sf_dir)).withColumn("kind", F.when(F.dayofmonth("ev_date") % 2 == 0, "roster").otherwise("turnout"))
    return A.cumulative_totals(days)


@query(f", {FIRST} SELECT ev_date, upper(trim(county)) AS county, method AS voting_method, count(*) AS n FROM first GROUP BY ALL", ("roster",))
def agg06_first_seen_counts(spark, sf_dir):
    return D.first_seen_counts(_keyed(spark, sf_dir))


BIG_FIRST = "first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_hash, occ) AS n FROM roster_big) WHERE n = 1)"


@query(f", {BIG_FIRST} SELECT ev_date, upper(county) AS county, method AS voting_method, count(*) AS n FROM first GROUP BY ALL", ("roster_big",))
def agg06_first_seen_counts_big(spark, sf_dir):
    return D.first_seen_counts(T.roster_big(spark, sf_dir))


@query(
    f""", {FIRST}, days AS (SELECT ev_date, {COUNTS} FROM roster WHERE method IS NOT NULL GROUP BY ev_date),
    new AS (SELECT ev_date, count(*) AS new_voters, count(*) FILTER (WHERE method = 'in_person') AS new_in_person, count(*) FILTER (WHERE method = 'mail_in') AS new_mail_in FROM first WHERE method IS NOT NULL GROUP BY ev_date)
    SELECT d.ev_date, in_person, mail_in, total, new_voters, new_in_person, new_mail_in, CASE WHEN new_voters IS NOT NULL THEN greatest(total - new_voters, 0) END AS restated_rows,
      CASE WHEN bool_or(new_voters IS NULL) OVER w THEN NULL ELSE CAST(sum(new_voters) OVER w AS BIGINT) END AS cumulative_unique_voters
    FROM days d LEFT JOIN new n ON d.ev_date = n.ev_date WINDOW w AS (ORDER BY d.ev_date ROWS UNBOUNDED PRECEDING)""",
    ("roster",),
)
def agg07_distinct_annotations(spark, sf_dir):
    """Days on which nobody appears first have no counts: they are unknown, and so are running counts after them."""
    rows = _keyed(spark, sf_dir)
    return D.distinct_annotations(A.by_day_series(rows), D.first_seen_counts(rows))


@query(
    """, r AS (SELECT *, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_hash, occ) AS n FROM roster_big) SELECT ev_date, upper(county) AS county, method AS voting_method, count(*) AS n FROM r WHERE n > 1 GROUP BY ev_date, 2, 3""",
    ("roster_big",),
)
def agg08_repeat_excess(spark, sf_dir):
    return D.repeat_excess(T.roster_big(spark, sf_dir))


def _changed_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Cells of a first load, in which odd days miss rows and have voters that go; of the odd days as they are now; all cells
    after that; and the touched voters."""
    rows = _keyed(spark, sf_dir)
    odd = F.dayofmonth("ev_date") % 2 == 1
    before = rows.where(~odd | (F.col("row_key") % 9 != 0)).withColumn("id_voter", F.when(odd & (F.col("row_key") % 23 == 0), F.concat(F.lit("7"), F.substring("id_voter", 2, 9))).otherwise(F.col("id_voter")))
    cells, new = D.voter_cells(before), D.voter_cells(rows.where(odd))
    return cells, new, D.replaced_days(cells, new, new.select("ev_date")), D.changed_voters(cells.where(odd), new)


@query(f""", {FIRST} SELECT ev_date, upper(county) AS county, method AS voting_method, count(*) AS n FROM first GROUP BY 1, 2, 3""", ("roster",))
def agg06_first_seen_kept_up(spark, sf_dir):
    """Counts of a first load, brought up to date after the odd days were published again: equal to a full build."""
    cells, _, after, touched = _changed_days(spark, sf_dir)
    own = lambda df: df.join(touched, "id_voter", "left_semi")
    return D.updated_first_seen(D.first_seen_of_cells(cells), own(cells), own(after))


@query(
    """, r AS (SELECT *, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_key) AS n FROM roster) SELECT ev_date, upper(county) AS county, method AS voting_method, count(*) AS n FROM r WHERE n > 1 GROUP BY ev_date, 2, 3""",
    ("roster",),
)
def agg08_excess_kept_up(spark, sf_dir):
    _, _, after, _ = _changed_days(spark, sf_dir)
    slices = ("ev_date", F.upper(F.trim("county")).alias("county"), S.normalize_method("voting_method").alias("voting_method"))
    return D.excess_of_cells(after, _keyed(spark, sf_dir).groupBy(*slices).agg(F.count("*").alias("n")))


def _removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.roster(spark, sf_dir).where("row_key % 41 = 0").select(F.when(F.col("row_key") % 2 == 0, F.concat(F.lit("9"), F.substring("id_voter", 2, 9))).otherwise(F.col("id_voter")).alias("id_voter"), "ev_date")


REMOVALS = "gone AS (SELECT CASE WHEN row_key % 2 = 0 THEN '9' || substr(id_voter, 2) ELSE id_voter END AS id_voter, ev_date FROM roster WHERE row_key % 41 = 0)"


@query(
    f""", {REMOVALS}, s AS (SELECT id_voter, count(*) AS n, list_sort(list(DISTINCT CAST(ev_date AS VARCHAR))) AS d, count(DISTINCT coalesce(method, '')) AS m FROM roster GROUP BY 1),
    g AS (SELECT id_voter, count(*) AS n_removed, list_sort(list(DISTINCT CAST(ev_date AS VARCHAR))) AS r FROM gone GROUP BY 1),
    b AS (SELECT coalesce(s.id_voter, g.id_voter) AS id_voter, CAST(coalesce(n, 0) AS INTEGER) AS n_counted, coalesce(n_removed, 0) AS n_removed, coalesce(d, []) AS d, coalesce(m, 0) AS m, coalesce(r, []) AS r FROM s FULL JOIN g ON s.id_voter = g.id_voter WHERE coalesce(n, 0) > 1 OR coalesce(n_removed, 0) > 0)
    SELECT id_voter, n_counted, n_removed, CAST(d[1] AS DATE) AS first_day, array_to_string(d, ',') AS counted_days, array_to_string(r, ',') AS removed_days,
      CAST(CASE WHEN len(d) < n_counted THEN 1 ELSE 0 END + CASE WHEN len(d) > 1 THEN 2 ELSE 0 END + CASE WHEN m > 1 THEN 4 ELSE 0 END + CASE WHEN n_removed > 0 THEN 8 ELSE 0 END AS INTEGER) AS flags FROM b""",
    ("roster",),
)
def agg09_repeat_voters(spark, sf_dir):
    days = lambda c: F.array_join(F.transform(c, lambda d: F.date_format(d, "yyyy-MM-dd")), ",")
    out = D.repeat_voters(_keyed(spark, sf_dir), _removals(spark, sf_dir))
    return out.select("id_voter", "n_counted", "n_removed", "first_day", days("counted_days").alias("counted_days"), days("removed_days").alias("removed_days"), "flags")


@query(
    f""", {REMOVALS}, s AS (SELECT id_voter, count(*) AS n, list_sort(list(DISTINCT CAST(ev_date AS VARCHAR))) AS d, count(DISTINCT coalesce(method, '')) AS m FROM roster GROUP BY 1),
    g AS (SELECT id_voter, count(*) AS n_removed, list_sort(list(DISTINCT CAST(ev_date AS VARCHAR))) AS r FROM gone GROUP BY 1),
    b AS (SELECT coalesce(s.id_voter, g.id_voter) AS id_voter, CAST(coalesce(n, 0) AS INTEGER) AS n_counted, coalesce(n_removed, 0) AS n_removed, coalesce(d, []) AS d, coalesce(m, 0) AS m, coalesce(r, []) AS r FROM s FULL JOIN g ON s.id_voter = g.id_voter WHERE coalesce(n, 0) > 1 OR coalesce(n_removed, 0) > 0)
    SELECT id_voter, n_counted, n_removed, CAST(d[1] AS DATE) AS first_day, array_to_string(d, ',') AS counted_days, array_to_string(r, ',') AS removed_days,
      CAST(CASE WHEN len(d) < n_counted THEN 1 ELSE 0 END + CASE WHEN len(d) > 1 THEN 2 ELSE 0 END + CASE WHEN m > 1 THEN 4 ELSE 0 END + CASE WHEN n_removed > 0 THEN 8 ELSE 0 END AS INTEGER) AS flags FROM b""",
    ("roster",),
)
def agg09_repeats_kept_up(spark, sf_dir):
    """The table of a first load; after the odd days were published again only touched voters are built anew."""
    days = lambda c: F.array_join(F.transform(c, lambda d: F.date_format(d, "yyyy-MM-dd")), ",")
    cells, _, after, touched = _changed_days(spark, sf_dir)
    removals = _removals(spark, sf_dir)
    out = D.updated_repeats(D.repeats_of_cells(cells, removals), touched, after.join(touched, "id_voter", "left_semi"), removals)
    return out.select("id_voter", "n_counted", "n_removed", "first_day", days("counted_days").alias("counted_days"), days("removed_days").alias("removed_days"), "flags")


@query(
    f""", {REMOVALS}, v AS (SELECT id_voter FROM roster GROUP BY 1 HAVING count(*) > 1 UNION SELECT id_voter FROM gone)
    SELECT id_voter, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_key) AS place, ev_date, method, upper(county) AS county FROM roster WHERE id_voter IN (SELECT id_voter FROM v)""",
    ("roster",),
)
def agg09_repeat_appearances(spark, sf_dir):
    return D.repeat_appearances(_keyed(spark, sf_dir), _removals(spark, sf_dir)).withColumn("place", F.col("place").cast("long"))


@query(
    f""", {REMOVALS}, v AS (SELECT id_voter, count(*) AS n FROM roster GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS raw_rows, count(*) AS distinct_voters, count(*) FILTER (WHERE n > 1) AS repeat_voters, CAST(sum(n - 1) AS BIGINT) AS excess, (SELECT count(DISTINCT id_voter) FROM gone) AS removed_voters FROM v""",
    ("roster",),
)
def agg10_repeat_summary(spark, sf_dir):
    return D.repeat_summary(T.roster(spark, sf_dir), _removals(spark, sf_dir))


@query(
    """, e AS (SELECT upper(county) AS county, count(*) AS n FROM roster GROUP BY 1), k AS (SELECT count(DISTINCT ev_date) AS k FROM roster), d AS (SELECT upper(county) AS county, count(*) AS rows FROM roster WHERE ev_date = DATE '2024-01-05' GROUP BY 1),
    b AS (SELECT e.county, coalesce(d.rows, 0) AS rows, CAST(round_even(n / k, 0) AS BIGINT) AS baseline FROM e CROSS JOIN k LEFT JOIN d ON d.county = e.county) SELECT * FROM b WHERE baseline >= 5 AND rows < 0.9 * baseline""",
    ("roster",),
)
def agg20_low_coverage(spark, sf_dir):
    rows = T.roster(spark, sf_dir)
    return A.low_coverage(rows.where("ev_date = '2024-01-05'"), rows, share=0.9, least=5)


@query(" SELECT 'method' AS dimension, trim(voting_method) AS value, count(*) AS n FROM roster GROUP BY 2 UNION ALL SELECT 'county', trim(county), count(*) FROM roster GROUP BY 2 UNION ALL SELECT 'rows', 'all', count(*) FROM roster", ("roster",))
def agg21_roster_summary(spark, sf_dir):
    return A.roster_summary(T.roster(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.roster(spark, sf_dir).withColumn("file_id", F.date_format("ev_date", "yyyyMMdd"))


PRECOMPUTED = f", f AS (SELECT *, strftime(ev_date, '%Y%m%d') AS file_id FROM roster), t AS (SELECT file_id, upper(county) AS county, {COUNTS} FROM f WHERE method IS NOT NULL GROUP BY GROUPING SETS ((file_id, upper(county)), (file_id)))"


@query(f"{PRECOMPUTED} SELECT *, count(county) OVER (PARTITION BY file_id) AS n_counties FROM t", ("roster",))
def agg22_precompute(spark, sf_dir):
    return A.precompute(_files(spark, sf_dir))


@query(f"{PRECOMPUTED}, n AS (SELECT file_id, count(county) AS n_counties FROM t GROUP BY 1) SELECT file_id, n_counties, CASE WHEN file_id LIKE '%3' THEN 0 ELSE n_counties END AS present, file_id NOT LIKE '%3' AS complete FROM n", ("roster",))
def agg22_complete_files(spark, sf_dir):
    stored = A.precompute(_files(spark, sf_dir))
    meta = stored.select("file_id", "n_counties").distinct()
    return A.complete_files(meta, stored.where("file_id not like '%3'"))


@query(
    """, d AS (SELECT precinct AS election_id, ev_date, count(*) AS n FROM roster GROUP BY ALL) SELECT election_id, min(ev_date) AS first_day, max(ev_date) AS last_day, CAST(sum(n) AS BIGINT) AS total_rows, string_agg(CAST(ev_date AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY ev_date) AS days FROM d GROUP BY 1""",
    ("roster",),
)
def agg23_election_summary(spark, sf_dir):
    return A.election_summary(T.roster(spark, sf_dir).withColumnRenamed("precinct", "election_id"))


_DIGEST = "sha256(CAST(count(*) AS VARCHAR) || ':' || " + " || ':' || ".join(f"CAST(sum(CAST(('0x' || substr(h, {1 + 15 * k}, 15)) AS BIGINT)) AS VARCHAR)" for k in range(4)) + ")"


@query(f"""WITH l AS (SELECT sha256('["' || CAST(o_orderkey AS VARCHAR) || '","' || o_orderstatus || '"]') AS h FROM orders), d AS (SELECT {_DIGEST} AS digest FROM l) SELECT sha256(digest || chr(10) || 'v1') AS signature FROM d""")
def agg24_build_signature(spark, sf_dir):
    return V.build_signature(T.table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus"], "v1")


# ---------------------------------------------------------------- windows and deduplication


@query(" SELECT id_voter, row_key, row_number() OVER (PARTITION BY id_voter ORDER BY day, row_key) AS rank FROM roster", ("roster",))
def win03_first_appearance_rank(spark, sf_dir):
    return O.first_appearance_rank(_keyed(spark, sf_dir)).select("id_voter", "row_key", F.col("rank").cast("long").alias("rank"))


@query(" SELECT day, county, precinct, CAST(row_number() OVER (PARTITION BY day, county, precinct) - 1 AS INTEGER) AS occ FROM roster", ("roster",))
def win04_occurrence_number(spark, sf_dir):
    rows = T.roster(spark, sf_dir).withColumn("day", S.day_number("ev_date")).withColumn("row_hash", S.row_hash(["county", "precinct"]))
    return O.occurrence_number(rows).select("day", "county", "precinct", "occ")


@query(
    """, g AS (SELECT id_voter, count(DISTINCT report_date) AS d, count(DISTINCT voting_method) AS m, count(DISTINCT county) AS c, count(DISTINCT voter_name) AS w, count(DISTINCT precinct) AS p FROM clean GROUP BY 1),
    t AS (SELECT id_voter, county, report_date, count(*) AS rows FROM clean GROUP BY ALL), k AS (SELECT id_voter, count(*) AS tokens FROM t GROUP BY 1)
    SELECT f.id_voter, f.pos, d > 1 OR m > 1 OR c > 1 OR w > 1 OR p > 1 AS duplicate_flag, concat_ws(',', CASE WHEN d > 1 THEN 'multiple_dates' END, CASE WHEN m > 1 THEN 'conflicting_method' END, CASE WHEN c > 1 THEN 'multiple_counties' END, CASE WHEN w > 1 THEN 'name_mismatch' END, CASE WHEN p > 1 THEN 'precinct_mismatch' END) AS duplicate_type,
      tokens - CASE WHEN t.rows = 1 THEN 1 ELSE 0 END AS n_other FROM clean f JOIN g ON f.id_voter = g.id_voter JOIN k ON f.id_voter = k.id_voter JOIN t ON f.id_voter = t.id_voter AND f.county = t.county AND f.report_date = t.report_date""",
    ("roster", "clean"),
)
def win05_flag_duplicates(spark, sf_dir):
    out = O.flag_duplicates(T.clean_roster(spark, sf_dir))
    n = F.when(F.col("also_found_on") == "", 0).otherwise(F.size(F.split("also_found_on", "; ")))
    return out.select("id_voter", "pos", "duplicate_flag", "duplicate_type", n.cast("long").alias("n_other"))


@query(
    """, f AS (SELECT *, first_value(county) OVER w AS c, first_value(precinct) OVER w AS p FROM roster WINDOW w AS (PARTITION BY id_voter ORDER BY day, row_key)) SELECT id_voter, bool_or(county <> c) AS multi_county, bool_or(county <> c OR precinct <> p) AS multi_place FROM f GROUP BY id_voter""",
    ("roster",),
)
def win06_multi_place_flags(spark, sf_dir):
    return O.multi_place_flags(_keyed(spark, sf_dir))


@query(" SELECT id_voter, arg_max(county, row_key) AS county, max(row_key) AS row_key FROM roster GROUP BY id_voter", ("roster",))
def ded01_last_row(spark, sf_dir):
    return O.last_row(T.roster(spark, sf_dir).select("id_voter", "county", "row_key"), ["id_voter"], ["row_key"])


@query("SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def ded02_first_row(spark, sf_dir):
    return O.first_row(T.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query(" SELECT count(*) - count(DISTINCT VUID) AS extra FROM register", ("register",))
def ded03_extra_rows(spark, sf_dir):
    return O.first_and_extra(T.register(spark, sf_dir), ["VUID"], ["pos"])[1]


@query(" SELECT VUID, count(*) AS n FROM register GROUP BY VUID HAVING count(*) > 1", ("register",))
def ded04_repeated_keys(spark, sf_dir):
    return O.repeated_keys(T.register(spark, sf_dir), ["VUID"])


@query("SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM orders GROUP BY 1")
def ded05_keep_last(spark, sf_dir):
    out = O.last_row(T.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return out.select("o_custkey", "o_totalprice")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def ded06_insert_or_ignore(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders")
    return O.insert_or_ignore(o.where("o_orderstatus = 'P'").select("o_custkey"), o.where("o_orderstatus = 'O'").select("o_custkey"), ["o_custkey"])


# ---------------------------------------------------------------- pages, sets, versions


@query(f"{VERSIONED} SELECT min(day) AS day, row_hash, occ FROM versioned WHERE (row_hash, occ) > (50, 3) GROUP BY row_hash, occ ORDER BY row_hash, occ LIMIT 100")
def top03_keyset_page(spark, sf_dir):
    """One row per key, as in a day's rows: the least day of each (row_hash, occ)."""
    rows = _versioned(spark, sf_dir).groupBy("row_hash", "occ").agg(F.min("day").alias("day"))
    return V.keyset_page(rows, (50, 3), 100)


@query(f"{VERSIONED} SELECT min(day) AS day, row_hash, occ FROM versioned WHERE (row_hash, occ) > (50, 3) GROUP BY row_hash, occ ORDER BY row_hash, occ LIMIT 100")
def top03_stored_page(spark, sf_dir):
    """The page from files in ranges of the key, of which it opens a few."""
    folder = _folder(spark)
    SD.store_pages(_versioned(spark, sf_dir).groupBy("row_hash", "occ").agg(F.min("day").alias("day")), folder, 16)
    return SD.stored_page(spark, folder, (50, 3), 100).select("day", "row_hash", "occ")


@query(f"{VERSIONED} SELECT day, row_hash, occ FROM versioned WHERE row_hash BETWEEN 20 AND 60")
def top04_stored_range(spark, sf_dir):
    folder = _folder(spark)
    SD.store_pages(_versioned(spark, sf_dir).select("day", "row_hash", "occ"), folder, 16)
    return SD.stored_range(spark, folder, 20, 60)


@query(f"{VERSIONED} SELECT day, row_hash, occ FROM versioned WHERE row_hash BETWEEN 20 AND 60")
def top04_hash_page(spark, sf_dir):
    return V.hash_page(_versioned(spark, sf_dir), 20, 60).select("day", "row_hash", "occ")


@query("SELECT l_orderkey, CAST(l_orderkey % 101 AS INTEGER) AS range FROM lineitem")
def fn24_range_of(spark, sf_dir):
    n = 101
    low = F.element_at(F.array(*[F.lit(a) for a, _ in S.key_ranges(n)]), (F.col("l_orderkey") % n + 1).cast("int"))
    return T.table(spark, sf_dir, "lineitem").select("l_orderkey", S.range_of(low + F.col("l_linenumber"), n).alias("range"))


@query(" SELECT 'a' AS side, id_voter, county FROM snap_prior UNION ALL SELECT 'b', id_voter, county FROM snap_current", ("roster", "snap"))
def set01_union_days(spark, sf_dir):
    a, b = (T.snapshot(spark, sf_dir, x).select(F.lit(n).alias("side"), "id_voter", "county") for n, x in (("a", False), ("b", True)))
    return O.union_days([a, b])


@query("SELECT DISTINCT o_orderkey AS file_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def ver08_stale_files(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_id"), "o_orderstatus")
    return V.stale_files(o, [o.where("o_orderstatus = 'F'"), T.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("file_id"))])


def _new_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of line items but for some, with some that are new."""
    lines = T.table(spark, sf_dir, "lineitem").where("l_suppkey % 5 != 0")
    moved = F.when(F.col("l_partkey") % 11 == 0, F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber"))
    return lines.select(F.col("l_orderkey").alias("day"), F.col("l_partkey").alias("row_hash"), moved.cast("int").alias("occ")).distinct()


LOADED = f"""{VERSIONED}, stored AS (SELECT DISTINCT day, row_hash, occ, 1 AS added_in, CAST(NULL AS INTEGER) AS removed_in FROM versioned),
file AS (SELECT DISTINCT l_orderkey AS day, l_partkey AS row_hash, CAST(CASE WHEN l_partkey % 11 = 0 THEN l_linenumber + 100 ELSE l_linenumber END AS INTEGER) AS occ FROM lineitem WHERE l_suppkey % 5 <> 0),
loaded AS (SELECT s.day, s.row_hash, s.occ, s.added_in, CAST(CASE WHEN f.day IS NULL THEN 2 END AS INTEGER) AS removed_in FROM stored s LEFT JOIN file f ON s.day = f.day AND s.row_hash = f.row_hash AND s.occ = f.occ
  UNION ALL SELECT f.day, f.row_hash, f.occ, 2, NULL FROM file f LEFT JOIN stored s ON s.day = f.day AND s.row_hash = f.row_hash AND s.occ = f.occ WHERE s.day IS NULL)"""


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned(spark, sf_dir).select("day", "row_hash", "occ", F.lit(1).alias("added_in"), F.lit(None).cast("int").alias("removed_in")).distinct()


@query(f"{LOADED} SELECT * FROM loaded")
def ver01_load_day_version(spark, sf_dir):
    return V.load_day_version(_stored(spark, sf_dir), _new_file(spark, sf_dir), 1)


@query(f"{LOADED} SELECT day, row_hash, occ, 1 AS added_in, 2 AS removed_in FROM stored UNION ALL SELECT day, row_hash, occ, 2, NULL FROM file")
def ver02_replace_day(spark, sf_dir):
    return V.replace_day(_stored(spark, sf_dir), _new_file(spark, sf_dir), 1)


@query(f"{LOADED} SELECT day, row_hash, occ, added_in, CAST(NULL AS INTEGER) AS removed_in FROM loaded WHERE added_in <= 1")
def ver04_recovered(spark, sf_dir):
    return V.recovered(V.load_day_version(_stored(spark, sf_dir), _new_file(spark, sf_dir), 1), 1)


@query(f"{LOADED} SELECT count(*) AS visible, TRUE AS ok FROM file UNION ALL SELECT count(*), FALSE FROM file WHERE day % 100 <> 0")
def ver05_publish_check(spark, sf_dir):
    """Of a file with three rejects: a whole load may be published, one that lost rows may not."""
    new = _new_file(spark, sf_dir)
    rows, lines = V.load_day_version(_stored(spark, sf_dir), new, 1), new.count() + 3
    return V.publish_check(rows, 2, 3, lines).union(V.publish_check(rows.where("day % 100 != 0"), 2, 3, lines))


@query(f"{LOADED} SELECT day, row_hash, occ, added_in, CAST(CASE WHEN removed_in IS NULL AND added_in = 2 THEN 3 ELSE removed_in END AS INTEGER) AS removed_in FROM loaded UNION ALL SELECT day, row_hash, occ, 3, NULL FROM loaded WHERE removed_in = 2")
def ver01_stored_loads(spark, sf_dir):
    """Three loads of bucketed files, the first one's rows coming back in the third: stored rows are merged where they are."""
    folder = _folder(spark)
    first = _stored(spark, sf_dir).select("day", "row_hash", "occ")
    for file in (first, _new_file(spark, sf_dir), first):
        SD.load_stored_day(spark, folder, 1, file, 8)
    return SD.stored_day(spark, folder, 1)


@query(f"{LOADED} SELECT day, row_hash, occ, added_in, CAST(CASE WHEN removed_in IS NULL AND added_in = 2 THEN 3 ELSE removed_in END AS INTEGER) AS removed_in FROM loaded UNION ALL SELECT day, row_hash, occ, 3, NULL FROM loaded WHERE removed_in = 2")
def ver03_revived_keys(spark, sf_dir):
    """The first file comes back as the third: keys that were closed get rows of their own again."""
    stored = _stored(spark, sf_dir)
    second = V.load_day_version(stored, _new_file(spark, sf_dir), 1)
    return V.load_day_version(second, stored.select("day", "row_hash", "occ"), 2)


@query(f"{VERSIONED} SELECT * FROM versioned WHERE removed_in IS NULL OR removed_in > 3")
def ver06_collected(spark, sf_dir):
    return V.collected(_versioned(spark, sf_dir), 3)


@query(f"{UNTIDY} SELECT 'e1' AS election_id, DATE '2024-01-07' AS ev_date, CASE side WHEN 'a' THEN 'removed' ELSE 'added' END AS change_kind, id_voter FROM last l WHERE NOT EXISTS (SELECT 1 FROM last o WHERE o.id_voter = l.id_voter AND o.side <> l.side)", ("roster", "snap"))
def ver07_change_log(spark, sf_dir):
    old, new = T.snapshot(spark, sf_dir, False), T.snapshot(spark, sf_dir, True)
    return C.change_log(old, new, "e1", "2024-01-07", "s1", "s2", "2024-01-08 00:00:00").select("election_id", "ev_date", "change_kind", "id_voter")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'early' ELSE o_orderstatus END AS vote_period, CAST(NULL AS DOUBLE) AS south FROM orders")
def ver09_with_defaults(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("vote_period"))
    return V.with_defaults(o, {"vote_period": ("string", "early"), "south": ("double", None)})


@query(
    """SELECT p_partkey AS k, 'write' AS action FROM part WHERE p_partkey % 7 <> 0 AND (p_partkey % 5 = 0 OR p_partkey % 3 = 0) UNION ALL SELECT p_partkey, 'delete' FROM part WHERE p_partkey % 7 = 0 AND p_partkey % 5 <> 0"""
)
def snk06_diff_upsert(spark, sf_dir):
    p = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    stored = p.where("k % 5 != 0").withColumn("h", S.row_hash(["k"]))
    new = p.where("k % 7 != 0").withColumn("h", F.when(F.col("k") % 3 == 0, F.lit(1).cast("long")).otherwise(S.row_hash(["k"])))
    write, delete = V.diff_upsert(stored, new, ["k"], "h")
    return write.select("k", F.lit("write").alias("action")).union(delete.select("k", F.lit("delete")))


@query(f"{MATCH} SELECT id_voter, county, precinct, voting_method, CASE WHEN in_register THEN 'true' ELSE 'false' END AS in_voterfile, coalesce(cd, '') AS cd, coalesce(vf_county, '') AS vf_county, coalesce(age_bracket, '') AS age_bracket FROM enriched", ("roster", "clean", "register"))
def snk02_enriched_csv(spark, sf_dir):
    """The enriched roster as CSV, read back as texts; nulls are empty."""
    folder = _folder(spark)
    K.write_enriched_csv(_enriched(spark, sf_dir), folder)
    columns = ["id_voter", "county", "precinct", "voting_method", "in_voterfile", "cd", "vf_county", "age_bracket"]
    return I.text_csv(spark, folder).na.fill("").select(*columns)


@query(f"{GAPS} SELECT county, CAST(gap_total AS BIGINT) AS gap_total FROM gaps UNION ALL SELECT NULL, CAST(sum(gap_total) AS BIGINT) FROM gaps", _GAP_VIEWS)
def snk04_gap_report(spark, sf_dir):
    """Counties from the CSV, and the statewide row from the JSON."""
    folder, gaps = _folder(spark), _gaps(spark, sf_dir)
    K.write_gap_report(gaps, Q.gap_summary(gaps, T.clean_roster(spark, sf_dir)), folder)
    counties = I.text_csv(spark, f"{folder}/counties").select("county", F.col("gap_total").cast("long").alias("gap_total"))
    state = spark.read.json(f"{folder}/summary").select(F.lit(None).cast("string").alias("county"), F.col("gap_total").cast("long").alias("gap_total"))
    return counties.union(state)


@query(" SELECT 'rows' AS part, count(*) AS n FROM clean UNION ALL SELECT 'voters', count(*) FROM (SELECT id_voter FROM clean GROUP BY 1 HAVING count(*) > 1)", ("roster", "clean"))
def snk05_report(spark, sf_dir):
    """The audit's findings and a summary as JSON, read back."""
    folder, rows = _folder(spark), T.clean_roster(spark, sf_dir)
    K.write_report(Q.audit_findings(rows, T.turnout(spark, sf_dir)), rows.agg(F.count("*").alias("n")), folder)
    repeats = spark.read.json(f"{folder}/findings").where("finding_type = 'duplicate_vuid'").select(F.lit("voters").alias("part"), F.col("affected").alias("n"))
    return spark.read.json(f"{folder}/summary").select(F.lit("rows").alias("part"), "n").union(repeats)


@query("SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS h FROM part WHERE p_partkey % 7 <> 0")
def snk07_publish(spark, sf_dir):
    """A published version, and a second one by upsert; the manifest's last row names what is read."""
    folder, p = _folder(spark), T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    K.publish(p.where("k % 5 != 0").withColumn("h", F.lit(0)), folder, 1, "s1")
    K.apply_upsert(spark, folder, p.where("k % 7 != 0").withColumn("h", F.when(F.col("k") % 3 == 0, 1).otherwise(0)), ["k"], "h", 2)
    return K.read_published(spark, folder)


@query(" SELECT ev_date, sha, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT ev_date, 'a' AS sha FROM roster UNION ALL SELECT ev_date, 'b' FROM roster WHERE day(ev_date) % 2 = 0) GROUP BY ALL", ("roster",))
def snk08_snapshot_versions(spark, sf_dir):
    """All days are kept, then those of another digest only; the files' rows are counted."""
    folder = _folder(spark)
    rows = T.roster(spark, sf_dir).select("id_voter", "ev_date", F.lit("a").alias("sha256"))
    first = K.snapshot_versions(rows, None, folder)
    again = rows.withColumn("sha256", F.when(F.dayofmonth("ev_date") % 2 == 0, "b").otherwise("a"))
    K.snapshot_versions(again, first, folder)
    return spark.read.parquet(folder).groupBy(F.col("ev_date").cast("date").alias("ev_date"), F.col("sha256").alias("sha")).agg(F.count("*").alias("n_rows"))


@query(" SELECT ev_date, id_voter, county FROM roster", ("roster",))
def snk09_export_days(spark, sf_dir):
    """All days as one CSV, the day first."""
    folder = _folder(spark)
    K.export_days(T.roster(spark, sf_dir).select("id_voter", "county", "ev_date"), folder)
    out = I.text_csv(spark, folder)
    return I.require_columns(out, ["EV_DATE", "id_voter", "county"]).select(F.col("EV_DATE").cast("date").alias("ev_date"), "id_voter", "county")


@query(
    """, v AS (SELECT precinct AS election_id, id_voter, count(*) AS n FROM roster GROUP BY ALL) SELECT election_id, CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_voters, count(*) FILTER (WHERE n > 1) AS duplicate_voters, 'election ' || election_id AS election_name FROM v GROUP BY election_id""",
    ("roster",),
)
def snk10_election_index(spark, sf_dir):
    rows = T.roster(spark, sf_dir).withColumnRenamed("precinct", "election_id")
    return K.election_index(rows, rows.select("election_id").distinct().withColumn("election_name", F.concat(F.lit("election "), F.col("election_id"))))


# ---------------------------------------------------------------- scores and scalar functions


def _scores_sql() -> str:
    from tallyframe.schemas import HISTORY, MIDTERM, OFF_YEAR, PRESIDENTIAL, PRIMARIES

    n = lambda test, columns: " + ".join(f"CAST({test.format(c=c)} AS INTEGER)" for c in columns)
    return f""", s AS (SELECT lpad(VUID, 10, '0') AS vuid, pos, CAST(c AS INTEGER) AS day, {n("{c} <> ''", HISTORY)} AS n_voted, {n("length({c}) > 1 AND right({c}, 1) = 'E'", HISTORY)} AS n_early, {n("length({c}) > 1 AND right({c}, 1) = 'A'", HISTORY)} AS n_absentee,
      {n("{c} <> ''", PRESIDENTIAL)} AS n_gen_pres, {n("{c} <> ''", MIDTERM)} AS n_gen_mid, {n("{c} <> ''", OFF_YEAR)} AS n_gen_off, {n("left({c}, 1) = 'R'", PRIMARIES)} AS n_primary_r, {n("left({c}, 1) = 'D'", PRIMARIES)} AS n_primary_d
      FROM (SELECT *, CASE WHEN pos % 4 <> 0 THEN pos % 11 + 1 END AS c FROM register WHERE SEX IN ('F', 'M', 'U'))), m AS (SELECT *, n_voted - n_early - n_absentee AS n_election_day, greatest(n_early, n_absentee, n_voted - n_early - n_absentee) AS top FROM s)
    SELECT vuid, pos, n_voted, n_early, n_absentee, n_election_day, n_gen_pres, n_gen_mid, n_gen_off, n_primary_r, n_primary_d,
      CASE WHEN n_primary_r > 0 AND n_primary_d > 0 THEN 'mixed' WHEN n_primary_r > 0 THEN 'straight_r' WHEN n_primary_d > 0 THEN 'straight_d' ELSE 'none' END AS primary_pattern,
      CASE WHEN n_gen_pres > 0 AND n_gen_mid > 0 THEN 'both' WHEN n_gen_pres > 0 THEN 'presidential_only' WHEN n_gen_mid > 0 THEN 'midterm_only' ELSE 'none' END AS general_pattern,
      CASE WHEN top = 0 THEN NULL WHEN CAST(n_early = top AS INTEGER) + CAST(n_absentee = top AS INTEGER) + CAST(n_election_day = top AS INTEGER) > 1 THEN 'mixed' WHEN n_early = top THEN 'early' WHEN n_absentee = top THEN 'absentee' ELSE 'election_day' END AS typical_mode,
      CASE WHEN n_voted > 0 THEN round_even((n_early + n_absentee) / n_voted, 4) END AS early_or_absentee_share, CAST(CASE WHEN day IS NULL THEN 0 ELSE 1 END AS INTEGER) AS earliness_n, CASE WHEN day IS NOT NULL THEN round_even((11 - day) / 10, 4) END AS typical_earliness FROM m"""


@query(_scores_sql(), ("register",))
def fn11_voter_scores(spark, sf_dir):
    voters, _ = R.parse_voter(T.register(spark, sf_dir), "2026-11-03", keep=("pos",))
    dated = voters.withColumn("pri26_day", F.when(F.col("pos") % 4 != 0, (F.col("pos") % 11 + 1).cast("int")))
    names = "n_voted n_early n_absentee n_election_day n_gen_pres n_gen_mid n_gen_off n_primary_r n_primary_d primary_pattern general_pattern typical_mode early_or_absentee_share earliness_n typical_earliness"
    return R.voter_scores(dated).select("vuid", "pos", *names.split())


@query(
    """SELECT event_id, lpad(right('00' || CAST(event_id AS VARCHAR) || CAST(user_id AS VARCHAR), 10), 10, '0') AS fn01, lpad(CAST(event_id AS VARCHAR), CAST(greatest(3, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') AS fn02, regexp_replace(upper('La Salle-' || event_type || ' ' || CAST(event_id AS VARCHAR)), '[^A-Z]', '', 'g') AS fn03, lpad(right(CAST(event_id AS VARCHAR), 4), 4, '0') AS fn04,
      CASE event_type WHEN 'click' THEN 'in_person' WHEN 'view' THEN 'mail_in' END AS fn05, CASE WHEN event_type = 'view' THEN 'MAIL-IN' ELSE 'IN-PERSON' END AS fn06,
      datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) + 1 AS fn16, CAST(ts AS DATE) AS fn16_back, ltrim(lpad(CAST(event_id % 50 AS VARCHAR), 3, '0'), '0') || 'A' AS fn17, CASE event_type WHEN 'click' THEN 'primary_runoff' WHEN 'view' THEN 'primary' WHEN 'purchase' THEN 'general' WHEN 'signup' THEN 'special' ELSE 'unknown' END AS fn19,
      round_even(value / 7, 6) AS fn23, 'A|' || strftime(ts, '%Y-%m-%d') AS fn25, 'a_' || CAST(event_id AS VARCHAR) || '_b' AS fn26, event_type = 'view' AS fn27, CASE WHEN event_id % 2 = 0 THEN 'x' END AS fn22,
      CASE WHEN event_id % 3 = 0 THEN 'early' WHEN event_id % 3 = 1 THEN 'election_day' ELSE 'absentee' END AS fn10, CAST((2 * (event_id % 2) + 1) AS INTEGER) AS fn18, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN date_trunc('second', ts) ELSE ts END AS fn21 FROM events"""
)
def fn_scalars(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    k, kind = F.col("event_id"), F.col("event_type")
    text = k.cast("string")
    pick = lambda **v: F.create_map(*[x for a, b in v.items() for x in (F.lit(a), F.lit(b))])
    of = lambda default, **v: F.coalesce(F.try_element_at(pick(**v), kind), F.lit(default))
    stamp = F.when(k % 4 == 0, "soon").when(k % 4 == 1, F.date_format("ts", "M/d/yyyy h:mm:ss a")).otherwise(F.col("ts").cast("string"))
    return e.select(
        "event_id",
        S.normalize_vuid(F.concat(F.lit(" 00"), text, F.lit("-"), F.col("user_id").cast("string"))).alias("fn01"),
        S.zfill(text, 3).alias("fn02"), S.county_key(F.concat(F.lit("La Salle-"), kind, F.lit(" "), text)).alias("fn03"), S.normalize_precinct(F.concat(F.lit("pct 00"), text)).alias("fn04"),
        S.normalize_method(of("other", click=" in person ", view="Mail")).alias("fn05"), S.parse_method(of("x", view="by mail")).alias("fn06"),
        S.day_number("ts").cast("long").alias("fn16"), S.day_of_number(S.day_number("ts")).alias("fn16_back"), S.district_key(F.concat(F.lit(" "), F.lpad((k % 50).cast("string"), 3, "0"), F.lit("a "))).alias("fn17"),
        S.election_type(of("x", click="2024 Primary Runoff", view="PRIMARY", purchase="a General one", signup="Special runoff")).alias("fn19"),
        S.coordinate(F.col("value") / 7).alias("fn23"), S.appearance_token(F.lit("A"), "ts").alias("fn25"), S.safe_filename_component(F.concat(F.lit("a /"), text, F.lit("?b"))).alias("fn26"),
        S.has_duplicate_flag(of("a,bx", view="a, b"), "b").alias("fn27"), S.clean_cell(F.when(k % 2 == 0, " x ").otherwise(" null"), True).alias("fn22"),
        S.vote_mode(F.when(k % 3 == 0, "VE").when(k % 3 == 1, "A").otherwise("RA")).alias("fn10"), S.pack_bits(F.lit(True), k % 2 == 1).alias("fn18"),
        S.updated_time(stamp).alias("fn21"),
    )


@query(" SELECT VUID, pos, CASE WHEN age < 18 THEN NULL WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44' WHEN age <= 54 THEN '45-54' WHEN age <= 64 THEN '55-64' WHEN age <= 74 THEN '65-74' ELSE '75+' END AS bracket FROM (SELECT *, 2020 - year(strptime(DOB, '%Y%m%d')) - CAST('0229' < substr(DOB, 5, 4) AS INTEGER) AS age FROM register)", ("register",))
def fn07_age_bracket(spark, sf_dir):
    iso = F.concat_ws("-", F.substring("DOB", 1, 4), F.substring("DOB", 5, 2), F.substring("DOB", 7, 2))
    american = F.concat_ws("/", F.substring("DOB", 5, 2), F.substring("DOB", 7, 2), F.substring("DOB", 1, 4))
    dob = F.when(F.col("pos") % 3 == 0, F.col("DOB")).when(F.col("pos") % 3 == 1, iso).otherwise(american)
    return T.register(spark, sf_dir).select("VUID", "pos", S.age_bracket(dob, F.lit("2020-02-29").cast("date")).alias("bracket"))


@query(" SELECT VUID, pos, CASE WHEN year(d) >= 1950 AND d <= DATE '2000-01-01' THEN d END AS dob FROM (SELECT *, CAST(strptime(DOB, '%Y%m%d') AS DATE) AS d FROM register)", ("register",))
def fn09_ymd(spark, sf_dir):
    return T.register(spark, sf_dir).select("VUID", "pos", S.ymd("DOB", 1950, F.lit("2000-01-01").cast("date")).alias("dob"))


def _known_hashes() -> str:
    """SQL: BLAKE2b (8 bytes, big-endian, signed) of the two cells that ``fn15_exact_hashes`` hashes; null is four FF bytes."""
    prefixed = lambda x: b"\xff" * 4 if x is None else len(x).to_bytes(4, "big") + x.encode()
    exact = lambda *cells: int.from_bytes(hashlib.blake2b(b"".join(map(prefixed, cells)), digest_size=8).digest(), "big", signed=True)
    cases = " ".join(f"WHEN l_returnflag = '{a}' AND l_linestatus = '{b}' THEN {exact(None if a == 'N' else a, b * 3)}" for a in "ANR" for b in "FO")
    return f"CAST(CASE {cases} END AS BIGINT)"


@query(f"SELECT l_orderkey, l_linenumber, {_known_hashes()} AS hash FROM lineitem")
def fn15_exact_hashes(spark, sf_dir):
    rows = T.table(spark, sf_dir, "lineitem")
    cells = [F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.repeat("l_linestatus", F.lit(3))]
    return rows.select("l_orderkey", "l_linenumber", S.exact_row_hash(spark, cells).alias("hash"))


@query("SELECT count(DISTINCT (l_orderkey, l_linenumber, l_returnflag)) AS n_hashes, count(DISTINCT (l_orderkey, l_linenumber, l_returnflag)) AS n_exact FROM lineitem")
def fn15_row_hash(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))]
    rows = T.table(spark, sf_dir, "lineitem").select(S.row_hash(columns).alias("h"), S.exact_row_hash(spark, columns).alias("x"))
    return rows.agg(F.count_distinct("h").alias("n_hashes"), F.count_distinct("x").alias("n_exact"))


@query("""SELECT event_id, sha256('[{"key":"k","value":"' || regexp_extract(props, '[0-9]+') || '"}]') AS hash FROM events""")
def fn28_json_payload_hash(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select("event_id", S.json_payload_hash("props").alias("hash"))


@query(f"WITH l AS (SELECT o_custkey, sha256(CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus) AS h FROM orders) SELECT o_custkey, {_DIGEST} AS digest FROM l GROUP BY 1")
def fn29_day_digest(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(S.day_digest(S.canonical_line(["o_orderkey", "o_orderstatus"])).alias("digest"))


# ---------------------------------------------------------------- streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.table(spark, sf_dir, "events").schema
    # a pattern, as a stream's path must be one or a folder, and the table may be a file
    return T.keyed(T.roster(spark, sf_dir, spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")))


def _collected_stream(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there; each batch's output is a folder that a rerun of it overwrites."""
    spark = stream.sparkSession
    folder = _folder(spark)
    write = lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query(f" SELECT ev_date, {COUNTS} FROM roster WHERE method IS NOT NULL GROUP BY ev_date", ("roster",))
def str01_streaming_day_series(spark, sf_dir):
    """The last batch of a complete-mode stream is the whole series."""
    out = _collected_stream(streaming_day_series(_event_stream(spark, sf_dir)), "complete")
    last = out.agg(F.max("batch").alias("batch"))
    return out.join(F.broadcast(last), "batch").drop("batch")


def _stateful(spark: SparkSession) -> SparkSession:
    """A session like this one, with the state store that arbitrary state needs; this one's setting stays."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


@query(
    """, gone AS (SELECT id_voter, min(ev_date) AS ev_date FROM roster WHERE CAST(id_voter AS BIGINT) % 3 = 0 GROUP BY 1), rest AS (SELECT r.* FROM roster r ANTI JOIN gone g ON r.id_voter = g.id_voter AND r.ev_date = g.ev_date)
    SELECT id_voter, CAST(min(day) AS INTEGER) AS day, arg_min(row_key, day * 1000000000 + row_key) AS row_hash FROM rest GROUP BY id_voter""",
    ("roster",),
)
def str03_first_appearances_after_removals(spark, sf_dir):
    """Two loads: all appearances, then removals of a third of the voters' first days, by which later ones move up."""
    folder = _folder(spark)
    rows = _keyed(spark, sf_dir).select("id_voter", "ev_date", "day", "row_hash", "occ", F.lit("added").alias("change"))
    first = rows.where(F.col("id_voter").cast("long") % 3 == 0).groupBy("id_voter").agg(F.min("ev_date").alias("ev_date"))
    gone = rows.join(first, ["id_voter", "ev_date"], "left_semi").select(*rows.columns).withColumn("change", F.lit("removed"))
    own = _stateful(spark)
    for k, load in enumerate((rows, gone)):
        load.coalesce(2).write.parquet(f"{folder}/in/load={k}")
    stream = own.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/in/load=*")
    out = _collected_stream(first_appearances(stream), "update")
    last = out.groupBy("id_voter").agg(F.max_by(F.struct("day", "row_hash"), "batch").alias("x")).where("x.day is not null")
    return last.select("id_voter", "x.day", "x.row_hash")


@query(" SELECT id_voter, CAST(min(day) AS INTEGER) AS day, arg_min(row_key, day * 1000000000 + row_key) AS row_hash FROM roster GROUP BY id_voter", ("roster",))
def str03_first_appearances(spark, sf_dir):
    """State per voter; later batches give a voter again where its first appearance falls."""
    out = _collected_stream(first_appearances(_event_stream(_stateful(spark), sf_dir)), "update")
    best = out.groupBy("id_voter").agg(F.min(F.struct("day", "row_hash")).alias("x"))
    return best.select("id_voter", "x.day", "x.row_hash")


REPUBLISHED = """, odd AS (SELECT * FROM roster WHERE day(ev_date) % 2 = 1), second AS (SELECT ev_date, id_voter FROM roster WHERE day(ev_date) % 2 = 0 UNION ALL SELECT ev_date, id_voter FROM odd WHERE CAST(id_voter AS BIGINT) % 11 <> 4 UNION ALL SELECT ev_date, '8' || substr(id_voter, 2) FROM odd WHERE row_key % 10 = 0)"""


@query(
    f"""{REPUBLISHED} SELECT ev_date, 'rows' AS kind, count(*) AS n FROM second GROUP BY 1 UNION ALL SELECT ev_date, 'removed', count(DISTINCT id_voter) FROM odd WHERE CAST(id_voter AS BIGINT) % 11 = 4 GROUP BY 1
    UNION ALL SELECT ev_date, 'added', count(DISTINCT id_voter) FROM odd WHERE row_key % 10 = 0 GROUP BY 1""",
    ("roster",),
)
def str05_republished_days(spark, sf_dir):
    """Day files as CSV, ingested; then files of all days again, of which the odd ones have changed: only those get
    new versions, and the change log says who came and went."""
    folder = _folder(spark)
    rows = T.roster(spark, sf_dir).select("id_voter", "ev_date", "county", "voting_method", "precinct", F.col("row_key").alias("pos"))
    odd = F.dayofmonth("ev_date") % 2 == 1
    changed = rows.where(~odd | (F.col("id_voter").cast("long") % 11 != 4))
    new = rows.where(odd & (F.col("pos") % 10 == 0)).withColumn("id_voter", F.concat(F.lit("8"), F.substring("id_voter", 2, 9)))
    for k, load in enumerate((rows, changed.union(new))):
        # each load is several files, and a file may be a batch of its own: days are judged when they are whole
        publish_load(load.repartition(4), f"{folder}/in", f"{k}", "csv")
        stream = day_files(spark, f"{folder}/in", rows.schema, 3, "csv")
        ingest_days(stream, f"{folder}/in", f"{folder}/out", f"{folder}/state").awaitTermination()
    days = current_days(spark, f"{folder}/out").groupBy("ev_date").agg(F.count("*").alias("n")).select("ev_date", F.lit("rows").alias("kind"), "n")
    log = day_changes(spark, f"{folder}/out").groupBy("ev_date", F.col("change_kind").alias("kind")).agg(F.count("*").alias("n"))
    return days.union(log)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_series_with_unique_voters(spark, sf_dir)


__all__ = ["ORACLES", "QUERIES", "entry"]
