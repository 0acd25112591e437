"""The register of voters: matching rosters to it, attributes, histories and ages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.operators.roster import first_row
from tallyframe.schemas import AGE_TIERS, CALENDAR, GENERAL_CODES, HISTORY, MIDTERM, OFF_YEAR, PRESIDENTIAL, PRIMARIES, PRIMARY_CODES, SEXES

FIELDS = ("cd", "hd", "sd", "county", "precinct", "dob", "sex", "hispanic", "status")


def target_filter(register: DataFrame, rosters: DataFrame, id_column: str = "vuid") -> DataFrame:
    """JON02: register rows of voters on the rosters, by normalized ids."""
    targets = rosters.select(S.normalize_vuid("id_voter").alias("__id")).distinct()
    return register.withColumn("__id", S.normalize_vuid(id_column)).join(targets, "__id", "left_semi").drop("__id")


def match_register(roster: DataFrame, register: DataFrame, mapping: dict[str, str], day: str) -> DataFrame:
    """JON01: every roster row with in_register and the register's columns, cleaned.

    ``mapping``: field -> register column, as from ``detect_columns``. Of several register rows of an id the
    first (``pos``) counts. Only mapped columns of rows that can match are read and shuffled."""
    columns = [F.col(mapping[f]).cast("string").alias(f) if f in mapping else F.lit(None).cast("string").alias(f) for f in FIELDS]
    chosen = register.select(S.normalize_vuid(F.col(mapping["vuid"]).cast("string")).alias("__id"), "pos", *columns).where("__id != ''")
    targets = roster.select(S.normalize_vuid("id_voter").alias("__id")).distinct()
    one = first_row(chosen.join(targets, "__id", "left_semi"), ["__id"], ["pos"]).drop("pos").withColumn("in_register", F.lit(True))
    renamed = one.withColumnsRenamed({"county": "vf_county", "precinct": "vf_precinct"})
    joined = roster.withColumn("__id", S.normalize_vuid("id_voter")).join(renamed, "__id", "left").drop("__id")
    cleaned = {c: S.clean_cell(c, null_word=True) for c in ("cd", "hd", "sd", "vf_county", "vf_precinct", "sex", "hispanic", "status")}
    return joined.withColumns(cleaned | {"in_register": F.coalesce("in_register", F.lit(False)), "age_bracket": S.age_bracket("dob", F.lit(day).cast("date"))}).drop("dob")


def match_breakdowns(enriched: DataFrame) -> DataFrame:
    """AGG14: dimension, value, n over matched rows; blanks are ``Unknown``. One pass, one shuffle."""
    names = {"cd": "cd", "hd": "hd", "sd": "sd", "county": "county", "age_bracket": "age_bracket", "sex": "sex", "voting_method": "voting_method", "hispanic": "hispanic"}
    value = lambda c: F.coalesce(S.clean_cell(c), F.lit("Unknown"))
    parts = F.array(*[F.struct(F.lit(d).alias("dimension"), value(c).alias("value")) for d, c in names.items()])
    return enriched.where("in_register").select(F.explode(parts).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def match_summary(enriched: DataFrame) -> DataFrame:
    """AGG14: rows, matched, unmatched, match_rate, and matched rows whose county or precinct differs."""
    matched = F.col("in_register")
    county = matched & (F.upper("county") != F.upper("vf_county"))
    precinct = matched & (F.trim("precinct") != "") & (S.normalize_precinct("precinct") != S.normalize_precinct("vf_precinct"))
    out = enriched.agg(F.count("*").alias("total"), F.count_if(matched).alias("matched"), F.count_if(county).alias("county_mismatch"), F.count_if(precinct).alias("precinct_mismatch"))
    return out.withColumn("unmatched", F.col("total") - F.col("matched")).withColumn("match_rate", F.when(F.col("total") > 0, F.col("matched") / F.col("total")).otherwise(0.0))


def parse_voter(df: DataFrame, today: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """PRJ03: (voters, rejects) from the register's 21 text columns.

    Blank cells are null. A sex or a history code outside its set rejects, a blank sex too; a bad date is
    null and sets a flag (1: birth, 2: registration). Reasons are field:kind, never values. ``keep``: other
    columns that voters keep."""
    day = F.lit(today).cast("date")
    codes = lambda c: GENERAL_CODES if c.startswith("GEN") else PRIMARY_CODES
    # The tests are on raw cells, apart from the cleaned ones that are selected: where a filter holds the
    # expressions of many aliases, the optimizer's constraints double with each.
    raw = lambda c: F.coalesce(F.trim(c), F.lit(""))
    problems = [F.when(~F.rlike(raw("VUID"), F.lit("^[0-9]{1,10}$")), "vuid:digits"), F.when(raw("SEX") == "", "sex:blank").when(~raw("SEX").isin(*SEXES), "sex:code")]
    problems += [F.when(~raw(c).isin("", *codes(c)), f"{c.lower()}:code") for c in HISTORY]
    out = df.withColumn("vuid", S.zfill(F.trim("VUID"), 10)).withColumn("errors", F.array_compact(F.array(*problems)))
    dates = {"dob": S.ymd(F.trim("DOB"), 1880, day), "edr": S.ymd(F.trim("EDR"), 1900, day)}
    flags = S.pack_bits((raw("DOB") != "") & dates["dob"].isNull(), (raw("EDR") != "") & dates["edr"].isNull())
    voters = out.where(F.size("errors") == 0).select("vuid", *keep, S.clean_cell("SEX").alias("sex"), dates["dob"].alias("dob"), dates["edr"].alias("edr"), flags.alias("flags"), *[S.clean_cell(c).alias(c.lower()) for c in HISTORY])
    return voters, out.where(F.size("errors") > 0).select("vuid", F.array_join("errors", ",").alias("reason"))


def voter_scores(voters: DataFrame) -> DataFrame:
    """FN11: fifteen columns derived from the history columns and, where present, gen25_day, pri26_day and
    ro26_day (the early day voted on)."""
    cast = lambda names: F.filter(F.array(*[F.col(c.lower()) for c in names]), lambda x: x.isNotNull() & (x != ""))
    count = lambda names, test=None: F.size(F.filter(cast(names), test) if test else cast(names))
    out = voters.withColumns(
        {
            "n_voted": count(HISTORY),
            "n_early": count(HISTORY, lambda x: S.vote_mode(x) == "early"),
            "n_absentee": count(HISTORY, lambda x: S.vote_mode(x) == "absentee"),
            "n_election_day": count(HISTORY, lambda x: S.vote_mode(x) == "election_day"),
            "n_gen_pres": count(PRESIDENTIAL),
            "n_gen_mid": count(MIDTERM),
            "n_gen_off": count(OFF_YEAR),
            "n_primary_r": count(PRIMARIES, lambda x: F.startswith(x, F.lit("R"))),
            "n_primary_d": count(PRIMARIES, lambda x: F.startswith(x, F.lit("D"))),
        }
    )
    days = {key: n for key, _, n, _, current, _ in CALENDAR if not current}
    timings = F.array_compact(F.array(*[S.earliness(f"{k.lower()}_day", F.lit(n)) for k, n in days.items() if f"{k.lower()}_day" in voters.columns])) if any(f"{k.lower()}_day" in voters.columns for k in days) else F.array().cast("array<double>")
    total = F.aggregate(timings, F.lit(0.0), lambda a, x: a + x)
    return out.withColumns(
        {
            "primary_pattern": S.pattern(F.col("n_primary_r"), F.col("n_primary_d"), ("mixed", "straight_r", "straight_d", "none")),
            "general_pattern": S.pattern(F.col("n_gen_pres"), F.col("n_gen_mid"), ("both", "presidential_only", "midterm_only", "none")),
            "typical_mode": S.typical_mode(F.col("n_early"), F.col("n_absentee"), F.col("n_election_day")),
            "early_or_absentee_share": F.when(F.col("n_voted") > 0, F.bround((F.col("n_early") + F.col("n_absentee")) / F.col("n_voted"), 4)),
            "earliness_n": F.size(timings),
            "typical_earliness": F.when(F.size(timings) > 0, F.bround(total / F.size(timings), 4)),
        }
    )


def calendar_frame(spark: SparkSession) -> DataFrame:
    rows = [(k, d, n, f, c, list(ids)) for k, d, n, f, c, ids in CALENDAR]
    return spark.createDataFrame(rows, "key string, election_date string, early_days int, first_early_date string, is_current boolean, ids array<long>").withColumns({c: F.col(c).cast("date") for c in ("election_date", "first_early_date")})


def with_current_election(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """JON07: ``current_election``, the date of the current one, as a scalar that every row gets."""
    one = calendar.where("is_current").agg(F.min("election_date").alias("current_election"))
    return df.crossJoin(F.broadcast(one))


def age_tiers(voters: DataFrame, calendar: DataFrame, today: str) -> DataFrame:
    """JON06: age and tier today and on the current election's day. Below 18, and without a birth date,
    the tier is null. The tiers are a fixed table of seven rows."""
    tiers = voters.sparkSession.createDataFrame(list(AGE_TIERS), "low int, high int, label string, sort int")
    out = with_current_election(voters, calendar).select("vuid", S.age_at("dob", F.lit(today).cast("date")).alias("age_today"), S.age_at("dob", "current_election").alias("age_election_day"))
    for name in ("today", "election_day"):
        tier = tiers.select(F.col("low").alias(f"__low_{name}"), F.col("high").alias(f"__high_{name}"), F.col("label").alias(f"age_tier_{name}"))
        out = out.join(F.broadcast(tier), F.col(f"age_{name}").between(F.col(f"__low_{name}"), F.col(f"__high_{name}")), "left").drop(f"__low_{name}", f"__high_{name}")
    return out


def dated_first_vote(files: DataFrame, targets: DataFrame, keys: tuple[str, ...] = ("GEN25", "PRI26", "RO26")) -> DataFrame:
    """JON16: per target the lowest early-day number and its mode, for each dated election.

    ``files``: key, early_day, pos, id_voter, voting_method. Unknown methods are skipped; of rows on the same
    day the first by ``pos`` counts."""
    mode = F.when(F.col("voting_method") == "IN-PERSON", "E").when(F.col("voting_method") == "MAIL-IN", "A")
    rows = files.withColumn("id", S.normalize_vuid("id_voter")).withColumn("mode", mode).where("mode is not null")
    rows = rows.join(targets.select(S.normalize_vuid("id_voter").alias("id")).distinct(), "id", "left_semi")
    best = rows.groupBy("id").pivot("key", list(keys)).agg(F.min_by(F.struct("early_day", "mode"), F.struct("early_day", "pos")))
    return best.select("id", *[c.alias(a) for k in keys for c, a in ((F.col(k)["early_day"], f"{k.lower()}_day"), (F.col(k)["mode"], f"{k.lower()}_mode"))])


def check_calendar(calendar: DataFrame, listed: DataFrame) -> DataFrame:
    """JON22: ids of the calendar that aren't listed or whose date, number of early days or first one
    differ (``listed``: id, election_date, early_date)."""
    own = calendar.select("key", "election_date", "early_days", "first_early_date", F.explode("ids").alias("id"))
    found = listed.groupBy("id").agg(F.min("election_date").alias("l_date"), F.count_distinct("early_date").alias("l_days"), F.min("early_date").alias("l_first"))
    joined = own.join(found, "id", "left")
    differs = F.when(F.col("l_date").isNull(), "missing").when(F.col("l_date") != F.col("election_date"), "election_date").when(F.col("l_days") != F.col("early_days"), "early_days").when(F.col("l_first") != F.col("first_early_date"), "first_early_date")
    return joined.withColumn("warning", differs).where("warning is not null").select("id", "key", "warning")
