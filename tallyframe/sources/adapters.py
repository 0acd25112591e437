"""Views of the driver's tables as rosters, registers and turnout: the same arithmetic in Spark and in SQL.

Each view has a builder and, in ``SQL``, the text of a common table expression of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METHODS = {"click": "IN-PERSON", "view": " in person ", "purchase": "MAIL-IN", "signup": "Mail"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def roster(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events (a stream of them, if given) as appearances: id_voter, ev_date, row_key, voting_method, county,
    precinct, voter_name."""
    events = table(spark, sf_dir, "events") if events is None else events
    nation = table(spark, sf_dir, "nation").select((F.col("n_nationkey").cast("long")).alias("__n"), F.col("n_name").alias("county"))
    method = F.lit("PROVISIONAL")
    for kind, text in METHODS.items():
        method = F.when(F.col("event_type") == kind, text).otherwise(method)
    at = (F.col("user_id") + F.when(F.col("event_id") % 50 == 0, 1).otherwise(0)) % 25
    out = events.withColumn("__n", at).join(nation, "__n")
    return out.select(F.lpad(F.col("user_id").cast("string"), 10, "0").alias("id_voter"), F.to_date("ts").alias("ev_date"), F.col("event_id").alias("row_key"), method.alias("voting_method"), "county", (F.col("event_id") % 7).cast("string").alias("precinct"), F.concat(F.lit("NAME "), F.col("user_id").cast("string")).alias("voter_name"))


def keyed(rows: DataFrame) -> DataFrame:
    """Appearance order that SQL can share: the event's number stands for hash and occurrence."""
    return rows.select("*", (F.datediff("ev_date", F.lit("0001-01-01").cast("date")) + 1).alias("day"), F.col("row_key").alias("row_hash"), F.lit(0).alias("occ"))


def clean_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster with the two strict methods only, one election, dates as report_date."""
    text = F.upper(F.trim("voting_method"))
    method = F.when(text.isin("IN-PERSON", "IN PERSON"), "IN-PERSON").when(text.isin("MAIL-IN", "MAIL"), "MAIL-IN")
    return roster(spark, sf_dir).withColumn("voting_method", method).where("voting_method is not null").withColumn("report_date", F.col("ev_date")).withColumn("pos", F.col("row_key"))


def roster_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as appearances of customers; the large roster."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = lines.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    method = F.when(F.col("l_returnflag") == "N", "IN-PERSON").when(F.col("l_returnflag") == "A", "MAIL-IN").otherwise("PROVISIONAL")
    return out.select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("id_voter"), F.to_date("l_shipdate").alias("ev_date"), F.col("l_orderkey").alias("row_hash"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("occ"), (F.datediff(F.to_date("l_shipdate"), F.lit("0001-01-01").cast("date")) + 1).alias("day"), method.alias("voting_method"), F.col("n_name").alias("county"), (F.col("l_partkey") % 50).cast("string").alias("precinct"))


def snapshot(spark: SparkSession, sf_dir: str, current: bool) -> DataFrame:
    """Two files of all rows: each misses some voters and some rows, and the current one has other methods and
    counties of some voters."""
    rows = roster(spark, sf_dir).withColumn("pos", F.col("row_key"))
    voter = F.col("id_voter").cast("long")
    if not current:
        return rows.where((F.col("row_key") % 17 != 0) & (voter % 17 != 3))
    rows = rows.where((F.col("row_key") % 19 != 0) & (voter % 19 != 5))
    method = F.when((F.col("row_key") % 23 == 0) | (voter % 7 == 2), "MAIL-IN").otherwise(F.col("voting_method"))
    county = F.when((F.col("row_key") % 29 == 0) & (voter % 3 == 1), "NOWHERE").otherwise(F.col("county"))
    return rows.withColumn("voting_method", method).withColumn("county", county)


def turnout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published counts per county, off by one here and there; counties of no roster have 5 in person."""
    rows = clean_roster(spark, sf_dir).groupBy("county").agg(F.count_distinct("id_voter").alias("n"), F.count_distinct(F.when(F.col("voting_method") == "MAIL-IN", F.col("id_voter"))).alias("mail"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("county"))
    out = nation.join(rows, "county", "left")
    return out.select("county", F.col("k").cast("string").alias("county_id"), (F.col("k") * 10).alias("registered_voters"), (F.coalesce("n", F.lit(5)) + F.col("k") % 3 - 1).alias("total_in_person_votes"), F.coalesce("mail", F.lit(0)).alias("total_mail_votes"), F.lit("e1").alias("election_id"))


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a register: every tenth left out, every twentieth twice, with the history columns."""
    c = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))
    rows = c.where(F.col("k") % 10 != 3).withColumn("copy", F.explode(F.when(F.col("k") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    born = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("k") * 37 % 32000).cast("int"))
    code = lambda n, values: F.element_at(F.array(*[F.lit(v) for v in values]), ((F.col("k") * n) % len(values) + 1).cast("int"))
    from tallyframe.schemas import HISTORY

    history = {h: code(i + 3, GENERAL if h.startswith("GEN") else PRIMARY) for i, h in enumerate(HISTORY)}
    return rows.select(F.col("k").cast("string").alias("VUID"), (F.col("k") * 2 + F.col("copy")).alias("pos"), F.col("c_nationkey").cast("string").alias("CD"), F.col("c_mktsegment").alias("SD"), (F.col("k") % 150).cast("string").alias("HD"), F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("COUNTY"), F.lpad((F.col("k") % 7).cast("string"), 4, "0").alias("PCT"), F.date_format(born, "yyyyMMdd").alias("DOB"), F.when(F.col("k") % 3 == 0, "F").when(F.col("k") % 3 == 1, "M").when(F.col("k") % 50 == 2, "").when(F.col("k") % 50 == 5, "X").otherwise("U").alias("SEX"), F.when(F.col("k") % 11 == 0, "NULL").otherwise("Y").alias("HISPANIC"), F.lit("A").alias("STATUS"), F.when(F.col("k") % 13 == 0, "18991231").otherwise("20100203").alias("EDR"), *[x.alias(h) for h, x in history.items()])


GENERAL, PRIMARY = ("", "V", "VE", "VA", "VE"), ("", "D", "RE", "RA", "R", "DE", "")


def _case(n: int, values: tuple[str, ...]) -> str:
    return f"list_value({', '.join(repr(v) for v in values)})[CAST((c_custkey * {n}) % {len(values)} + 1 AS BIGINT)]"


def _history_sql() -> str:
    from tallyframe.schemas import HISTORY

    return ", ".join(f"{_case(i + 3, GENERAL if h.startswith('GEN') else PRIMARY)} AS {h}" for i, h in enumerate(HISTORY))


SQL = {
    "roster": """roster AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 10, '0') AS id_voter, CAST(ts AS DATE) AS ev_date, event_id AS row_key,
         CASE event_type WHEN 'click' THEN 'IN-PERSON' WHEN 'view' THEN ' in person ' WHEN 'purchase' THEN 'MAIL-IN' WHEN 'signup' THEN 'Mail' ELSE 'PROVISIONAL' END AS voting_method,
         n_name AS county, CAST(event_id % 7 AS VARCHAR) AS precinct, 'NAME ' || CAST(user_id AS VARCHAR) AS voter_name,
         datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) + 1 AS day,
         CASE event_type WHEN 'click' THEN 'in_person' WHEN 'view' THEN 'in_person' WHEN 'purchase' THEN 'mail_in' WHEN 'signup' THEN 'mail_in' END AS method
  FROM events JOIN nation ON n_nationkey = (user_id + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) % 25)""",
    "clean": """clean AS (
  SELECT id_voter, ev_date, row_key, CASE method WHEN 'in_person' THEN 'IN-PERSON' ELSE 'MAIL-IN' END AS voting_method, county, precinct, voter_name,
         ev_date AS report_date, row_key AS pos FROM roster WHERE method IS NOT NULL)""",
    "roster_big": """roster_big AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS id_voter, CAST(l_shipdate AS DATE) AS ev_date, l_orderkey AS row_hash, l_linenumber * 1000000 + l_partkey AS occ,
         datediff('day', DATE '0001-01-01', CAST(l_shipdate AS DATE)) + 1 AS day,
         CASE l_returnflag WHEN 'N' THEN 'in_person' WHEN 'A' THEN 'mail_in' END AS method, n_name AS county, CAST(l_partkey % 50 AS VARCHAR) AS precinct
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "snap": """snap_prior AS (
  SELECT *, row_key AS pos FROM roster WHERE row_key % 17 <> 0 AND CAST(id_voter AS BIGINT) % 17 <> 3
), snap_current AS (
  SELECT id_voter, CASE WHEN row_key % 23 = 0 OR CAST(id_voter AS BIGINT) % 7 = 2 THEN 'MAIL-IN' ELSE voting_method END AS voting_method,
         CASE WHEN row_key % 29 = 0 AND CAST(id_voter AS BIGINT) % 3 = 1 THEN 'NOWHERE' ELSE county END AS county, row_key AS pos
  FROM roster WHERE row_key % 19 <> 0 AND CAST(id_voter AS BIGINT) % 19 <> 5)""",
    "turnout": """turnout AS (
  SELECT n_name AS county, CAST(n_nationkey AS VARCHAR) AS county_id, CAST(n_nationkey AS BIGINT) * 10 AS registered_voters,
         coalesce(n, 5) + CAST(n_nationkey AS BIGINT) % 3 - 1 AS total_in_person_votes, coalesce(mail, 0) AS total_mail_votes, 'e1' AS election_id
  FROM nation LEFT JOIN (SELECT county, count(DISTINCT id_voter) AS n, count(DISTINCT CASE WHEN voting_method = 'MAIL-IN' THEN id_voter END) AS mail FROM clean GROUP BY county) c ON c.county = n_name)""",
    "register": f"""register AS (
  SELECT CAST(c_custkey AS VARCHAR) AS VUID, c_custkey * 2 + copy AS pos, CAST(c_nationkey AS VARCHAR) AS CD, c_mktsegment AS SD, CAST(c_custkey % 150 AS VARCHAR) AS HD,
         'C' || CAST(c_nationkey AS VARCHAR) AS COUNTY, lpad(CAST(c_custkey % 7 AS VARCHAR), 4, '0') AS PCT,
         strftime(DATE '1930-01-01' + CAST(c_custkey * 37 % 32000 AS INTEGER), '%Y%m%d') AS DOB,
         CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' WHEN c_custkey % 50 = 2 THEN '' WHEN c_custkey % 50 = 5 THEN 'X' ELSE 'U' END AS SEX,
         CASE WHEN c_custkey % 11 = 0 THEN 'NULL' ELSE 'Y' END AS HISPANIC, 'A' AS STATUS, CASE WHEN c_custkey % 13 = 0 THEN '18991231' ELSE '20100203' END AS EDR,
         {_history_sql()}
  FROM customer, (SELECT 0 AS copy UNION ALL SELECT 1) WHERE c_custkey % 10 <> 3 AND (copy = 0 OR c_custkey % 20 = 0))""",
}


def with_views(*names: str) -> str:
    """A WITH clause of the views."""
    return "WITH " + ", ".join(SQL[n] for n in names)
