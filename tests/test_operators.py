"""Operators on small fixtures: invariants, edge cases, files, versions and streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.operators import aggregates as A
from tallyframe.operators import changes as C
from tallyframe.operators import distinct as D
from tallyframe.operators import geo as G
from tallyframe.operators import register as R
from tallyframe.operators import roster as O
from tallyframe.operators import versions as V
from tallyframe.plans.series import day_series, ingest_day
from tallyframe.sources import readers as I
from tallyframe.sources import sinks as K
from tallyframe.sources import stored as SD
from tallyframe.streaming import ingest as ST


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expression.alias("x")).first()["x"]


def random_roster(spark, seed=1, voters=60, days=5):
    rnd = random.Random(seed)
    rows = []
    for day in range(days):
        for v in rnd.sample(range(voters), voters // 2):
            for _ in range(rnd.choice([1, 1, 1, 2])):
                rows.append((f"{v:010d}", dt.date(2024, 1, 1 + day), rnd.choice(["IN-PERSON", "MAIL-IN", "ODD"]), rnd.choice(["A", "B"]), str(rnd.randrange(3)), len(rows)))
    df = spark.createDataFrame(rows, "id_voter string, ev_date date, voting_method string, county string, precinct string, pos long")
    return O.canonical_rows(df, ["county", "id_voter", "voting_method", "precinct"]), rows


@pytest.mark.parametrize(
    ("raw", "want"),
    [("123", "0000000123"), (" 00-12 ", "0000000012"), ("12345678901", "2345678901"), ("abc", "0000000abc"), ("", "")],
)
def test_normalize_vuid(spark, raw, want):
    assert one(spark, S.normalize_vuid("v"), v=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("510", "0510"), ("0510", "0510"), ("123456", "3456"), ("0", "0000"), ("a1b2", "0012"), (" ab ", "AB"), ("", "")])
def test_normalize_precinct(spark, raw, want):
    assert one(spark, S.normalize_precinct("v"), v=raw) == want


def test_ages_on_leap_days(spark):
    age = S.age_at(F.to_date("a"), F.to_date("b"))
    assert one(spark, age, a="2004-02-29", b="2024-02-28") == 19
    assert one(spark, age, a="2004-02-29", b="2025-03-01") == 21
    assert one(spark, age, a="2004-02-29", b="2025-02-28") == 20


def test_hash_tells_null_from_blank(spark):
    rows = spark.createDataFrame([("", "a"), (None, "a"), ("a", "")], "x string, y string")
    assert rows.select(S.row_hash(["x", "y"]).alias("h")).distinct().count() == 3
    assert rows.select(S.exact_row_hash(spark, ["x", "y"]).alias("h")).distinct().count() == 3


def test_exact_hash_is_blake2b_over_prefixed_values(spark):
    import hashlib

    rows = [("ab", "c", 1), ("a", "bc", 1), (None, "abc", 1), ("", "abc", 1), ("é", "日本", -5)]
    frame = spark.createDataFrame(rows, "x string, y string, z int")
    got = [r.h for r in frame.select(S.exact_row_hash(spark, ["x", "y", "z"]).alias("h")).collect()]

    def one(row):
        raw = b"".join(b"\xff\xff\xff\xff" if v is None else len(str(v).encode()).to_bytes(4, "big") + str(v).encode() for v in row)
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)

    assert got == [one(r) for r in rows] and len(set(got)) == 5
    # a fixed vector: the values "ab" and "c"
    two = spark.createDataFrame([("ab", "c")], "x string, y string").select(S.exact_row_hash(spark, ["x", "y"]).alias("h")).first().h
    assert two.to_bytes(8, "big", signed=True).hex() == hashlib.blake2b(bytes.fromhex("0000000261620000000163"), digest_size=8).hexdigest()


def test_diff_of_null_and_untidy_cells(spark):
    schema = "id_voter string, county string, voting_method string, pos int"
    old = spark.createDataFrame([("1", None, None, 0), ("2", None, None, 1), ("3", " a ", "mail-in", 2), (None, "a", "x", 3), (" ", "a", "x", 4), ("0", "a", "x", 5)], schema)
    new = spark.createDataFrame([("1", None, None, 0), ("3", "A", "MAIL-IN", 1), ("4", None, " in-person", 2), ("4", " b", " in-person", 3)], schema)
    assert C.diff_rosters(old, old).count() == 0
    got = {tuple(r) for r in C.diff_rosters(old, new).collect()}
    assert got == {("removed", "0000000002", "", ""), ("added", "0000000004", "B", "IN-PERSON")}


def test_digest_of_lines_in_any_order(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("x"))
    digest = lambda df: df.agg(S.day_digest(F.col("x")).alias("d")).first().d
    assert digest(rows) == digest(rows.orderBy(F.desc("x")).repartition(7))
    assert digest(rows) != digest(rows.union(rows.limit(1))) != digest(rows.limit(499))


def test_key_ranges_tile():
    for n in (1, 2, 7, 101):
        ranges = S.key_ranges(n)
        assert ranges[0][0] == -(1 << 63) and ranges[-1][1] == (1 << 63) - 1
        assert all(b + 1 == c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))


def test_detect_columns():
    found = S.detect_columns(["VUID", "Lname", "CDPLANC2333", "HD2022", "SD_2022", "PCT", "Birth Date", "Sex"])
    assert {f: c for f, (c, _) in found.items()} == {"vuid": "VUID", "last_name": "Lname", "cd": "CDPLANC2333", "hd": "HD2022", "sd": "SD_2022", "precinct": "PCT", "dob": "Birth Date", "sex": "Sex"}
    assert S.column_conflicts({"cd": ("X", "exact"), "hd": ("X", "exact"), "sd": ("Y", "exact")}) == {"X": ["cd", "hd"]}


def test_validation_gives_reasons_without_values(spark):
    rows = spark.createDataFrame([("A", "N", "12", " mail-in "), ("", "N", "12x", "fax"), (None, None, "1", "IN-PERSON")], "county string, voter_name string, id_voter string, voting_method string")
    good, bad = O.validate_roster_rows(rows)
    assert [tuple(r) for r in good.collect()] == [("A", "N", "0000000012", "MAIL-IN")]
    assert sorted(r.reason for r in bad.collect()) == ["county:blank,id_voter:digits,voting_method:unknown", "county:blank,voter_name:blank"]
    assert {r.raw["id_voter"] for r in bad.collect()} == {"12x", "1"}


def test_rows_minus_excess_are_distinct_voters(spark):
    rows, raw = random_roster(spark)
    excess = D.repeat_excess(rows).agg(F.sum("n")).first()[0]
    assert len(raw) - excess == len({r[0] for r in raw})
    assert D.first_seen_counts(rows).agg(F.sum("n")).first()[0] == len({r[0] for r in raw})
    series = {r.ev_date: r for r in day_series(rows).collect()}
    last = series[max(series)]
    assert last.cumulative_total == sum(r[2] != "ODD" for r in raw)


def test_running_counts_stop_at_an_unknown_day(spark):
    days = spark.createDataFrame([(1, 5), (2, None), (3, 4)], "ev_date int, new_voters long")
    assert [r.cumulative_unique_voters for r in D.cumulative_unique_voters(days).orderBy("ev_date").collect()] == [5, None, None]


def test_flag_duplicates_lists_other_rows(spark):
    rows = spark.createDataFrame(
        [("1", dt.date(2024, 1, 1), "IN-PERSON", "A", "n", "1", 0), ("1", dt.date(2024, 1, 2), "MAIL-IN", "A", "n", "1", 1), ("1", dt.date(2024, 1, 1), "IN-PERSON", "A", "n", "1", 2), ("2", dt.date(2024, 1, 1), "IN-PERSON", "A", "n", "1", 3)],
        "id_voter string, report_date date, voting_method string, county string, voter_name string, precinct string, pos int",
    )
    got = {r.pos: r for r in O.flag_duplicates(rows).collect()}
    assert got[0].duplicate_type == "multiple_dates,conflicting_method"
    assert got[0].also_found_on == "A|2024-01-02; A|2024-01-01"
    assert got[1].also_found_on == "A|2024-01-01"
    assert (got[3].duplicate_flag, got[3].duplicate_type, got[3].also_found_on) == (False, "", "")


def test_versions_equal_a_model(spark):
    rnd = random.Random(4)
    columns = "day int, row_hash long, occ int"
    stored = spark.createDataFrame([], columns + ", added_in int, removed_in int")
    seen = {0: set()}
    for version in range(4):
        keys = {(1, rnd.randrange(12), 0) for _ in range(8)}
        stored = spark.createDataFrame(V.load_day_version(stored, spark.createDataFrame(sorted(keys), columns), version).collect(), stored.schema)
        seen[version + 1] = keys
        for v, want in seen.items():
            assert {tuple(r)[:3] for r in V.visible_at(stored, v).collect()} == want
    again = V.same_keys(stored, spark.createDataFrame(sorted(seen[4]), columns)).first()
    assert (again.added, again.removed) == (0, 0)
    assert {tuple(r)[:3] for r in V.live_rows(V.recovered(stored, 2)).collect()} == seen[2]


def test_ingest_day_counts_lines(spark):
    file = spark.createDataFrame([("A", "n", "1", "IN-PERSON", "1", dt.date(2024, 1, 1))] * 2, "county string, voter_name string, id_voter string, voting_method string, precinct string, ev_date date")
    rows = ingest_day(None, file, 0, n_rejects=1, n_lines=3)
    assert sorted(r.occ for r in rows.collect()) == [0, 1]
    with pytest.raises(ValueError):
        ingest_day(None, file, 0, n_rejects=0, n_lines=3)


def test_compare_snapshots_uses_sets(spark):
    schema = "id_voter string, county string, voting_method string, pos int"
    prior = spark.createDataFrame([("1", "A", "X", 0), ("1", "A", "Y", 1), ("2", "A", "X", 2), ("3", "A", "X", 3)], schema)
    current = spark.createDataFrame([("1", "A", "Y", 0), ("1", "A", "X", 1), ("2", "B", "X", 2)], schema)
    got = {(r.id_voter, r.anomaly_kind) for r in C.compare_snapshots(prior, current).collect()}
    assert got == {("1", "within_file_dup"), ("2", "county_changed"), ("3", "dropped_from_later")}


def test_low_coverage_divides_by_all_days(spark):
    early = spark.createDataFrame([(dt.date(2024, 1, 1), "a")] * 300 + [(dt.date(2024, 1, 2), "b")] * 100, "ev_date date, county string")
    got = A.low_coverage(early.where("county = 'b'"), early)
    assert [tuple(r) for r in got.collect()] == [("A", 0, 150)]


def test_register_first_row_wins(spark):
    register = spark.createDataFrame([("7", 2, "late"), ("07", 1, "first")], "VUID string, pos long, CD string")
    roster = spark.createDataFrame([("0000000007", "A", "1", "IN-PERSON"), ("0000000008", "A", "1", "IN-PERSON")], "id_voter string, county string, precinct string, voting_method string")
    got = {r.id_voter: r for r in R.match_register(roster, register, {"vuid": "VUID", "cd": "CD"}, "2024-01-01").collect()}
    assert got["0000000007"].cd == "first" and got["0000000007"].in_register
    assert not got["0000000008"].in_register


def test_point_in_polygon_on_edges(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    districts = spark.createDataFrame([(1, ring), (2, [(x + 1, y) for x, y in ring])], "district int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([("a", 0.5, 0.5), ("b", 0.5, 1.0), ("c", 0.0, 0.0), ("d", 5.0, 5.0), ("e", 1.0, 0.5)], "id_voter string, lat double, lon double")
    got = {r.id_voter: r.district for r in G.point_in_polygon(points, districts).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_point_in_polygon_of_many_edges(spark):
    """Rings of hundreds of edges, concave, small and large against the cells: equal to a ray through the whole ring."""
    import math

    rnd = random.Random(8)
    rings = {}
    for d, (x, y, r) in enumerate([(0, 0, 3), (1, 1, 0.1), (-2.5, 2.5, 1.25), (4, -4, 0.6)]):
        n = rnd.choice([5, 60, 300])
        rings[d] = [(x + r * rnd.uniform(0.5, 1) * math.cos(2 * math.pi * k / n), y + r * rnd.uniform(0.5, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rings[9] = [(0.0, -2.0), (2.0, -2.0), (2.0, -1.0), (1.0, -1.0), (1.0, -1.5), (0.0, -1.5)]
    points = [(f"p{k}", rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for k in range(3000)] + [(f"q{k}", -2 + k % 9 * 0.25, k // 9 * 0.25) for k in range(81)]

    def inside(ring, lat, lon):
        crossed = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > lat) != (by > lat) and lon < (bx - ax) * (lat - ay) / (by - ay) + ax:
                crossed = not crossed
        return crossed

    want = {name: min(own) for name, lat, lon in points if (own := [d for d, ring in rings.items() if inside(ring, lat, lon)])}
    frame = spark.createDataFrame(list(rings.items()), "district int, ring array<struct<x:double,y:double>>")
    got = {r.id_voter: r.district for r in G.point_in_polygon(spark.createDataFrame(points, "id_voter string, lat double, lon double"), frame).collect()}
    assert got == want
    cells = G.polygon_cells(frame, 0.25).where("district = 0").agg(F.count_if(F.col("edges").isNull()).alias("whole"), F.max(F.size("edges")).alias("most")).first()
    assert cells.whole > 20 and cells.most < len(rings[0]) or len(rings[0]) < 10


def test_csv_files_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("1", "IN-PERSON", '1"x', "A,B", "e", dt.date(2024, 1, 1), "N\nM", True, "multiple_dates", "A|2024-01-02")], "id_voter string, voting_method string, precinct string, county string, election_id string, report_date date, voter_name string, duplicate_flag boolean, duplicate_type string, also_found_on string")
    K.write_roster_csv(rows.withColumn("voter_name", F.lit("N")), str(tmp_path / "r"))
    got = I.read_roster_csv(spark, str(tmp_path / "r")).first()
    assert (got.id_voter, got.precinct, got.county, got.duplicate_flag, got.report_date) == ("0000000001", '1"x', "A,B", True, dt.date(2024, 1, 1))
    (tmp_path / "day.csv").write_text('﻿County_Name, voter_name ,ID_VOTER,VOTING_METHOD\n"A","x\ny",1,MAIL-IN\n', encoding="utf-8")
    day = I.read_day_roster(spark, str(tmp_path / "day.csv")).first()
    assert (day.county, day.voter_name, day.precinct) == ("A", "x\ny", "")
    (tmp_path / "bad.csv").write_text("COUNTY,COUNTY_NAME,VOTER_NAME,ID_VOTER,VOTING_METHOD\n")
    with pytest.raises(ValueError):
        I.read_day_roster(spark, str(tmp_path / "bad.csv"))


def test_turnout_files_by_date(spark, tmp_path):
    header = "election_id,report_date,county,county_id,registered_voters,in_person_votes_on_date,total_in_person_votes,total_mail_votes,roster_available,source\n"
    for name, county in (("turnout_ev_2024-01-01.csv", "A"), ("turnout_ev_2024-01-02.csv", "B"), ("turnout_all.csv", "C")):
        (tmp_path / name).write_text(header + f"e,2024-01-01,{county},,5,1,2,3,Yes,s\n")
    got = I.load_stored_turnout(spark, str(tmp_path), ["2024-01-01"]).collect()
    assert sorted(r.county for r in got) == ["A", "C"]
    assert got[0].county_id is None and got[0].roster_available and got[0].total_mail_votes == 3


def test_zip_rosters(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("ed.csv", "County,VOTER_NAME,ID_VOTER,VOTING_METHOD,PRECINCT\n travis ,x,1,IN-PERSON,2\n,y,2,IN-PERSON,3\n")
    got = I.unzip_rosters(spark, str(tmp_path)).collect()
    assert [(r.county, r.id_voter) for r in got] == [("TRAVIS", "1")]


def test_publish_is_atomic(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 10), (2, 20)], "k int, h long")
    K.publish(rows, path, 1, "s1")
    new = spark.createDataFrame([(2, 21), (3, 30)], "k int, h long")
    write, delete = K.apply_upsert(spark, path, new, ["k"], "h", 2, dry_run=True)
    assert sorted(r.k for r in write.collect()) == [2, 3] and [r.k for r in delete.collect()] == [1]
    new.write.parquet(f"{path}/data/v=3")  # a crash before the manifest
    assert sorted(r.k for r in K.read_published(spark, path).collect()) == [1, 2]
    K.apply_upsert(spark, path, new, ["k"], "h", 2)
    assert sorted(tuple(r) for r in K.read_published(spark, path).collect()) == [(2, 21), (3, 30)]
    assert K.published_version(spark, path)[0] == 2


DAY = "id_voter string, ev_date date, county string, voting_method string, precinct string, pos long"


def test_stream_loads_changed_days_once(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    files = [[("1", day, "A", "IN-PERSON", "1", 0), ("2", day, "A", "IN-PERSON", "1", 1)], [("1", day, "A", "IN-PERSON", "1", 0), ("3", day, "A", "MAIL-IN", "1", 1)]]
    for k, rows in enumerate([files[0], files[0], files[1]]):
        ST.publish_load(spark.createDataFrame(rows, DAY).coalesce(1), source, f"{k}")
        stream = ST.day_files(spark, source, spark.createDataFrame([], DAY).schema)
        ST.ingest_days(stream, source, target, str(tmp_path / "checkpoint")).awaitTermination()
        assert spark.read.parquet(f"{target}/manifest").count() == (1 if k < 2 else 2)
    assert sorted(r.id_voter for r in ST.current_days(spark, target).collect()) == ["1", "3"]
    changes = ST.day_changes(spark, target).collect()
    assert {(r.change_kind, r.id_voter) for r in changes} == {("removed", "0000000002"), ("added", "0000000003")}


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_a_day_of_several_files_is_judged_whole(spark, tmp_path, kind):
    """One file a batch, by default: a day of three files is one version, with nothing logged as removed."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    rows = [(f"{v:010d}", days[v % 2], "A", "IN-PERSON", "1", v) for v in range(60)]
    again = [r for r in rows if r[5] != 7]
    for k, load in enumerate((rows, again)):
        ST.publish_load(spark.createDataFrame(load, DAY).repartition(3), source, f"{k}", kind)
        ST.ingest_days(ST.day_files(spark, source, spark.createDataFrame([], DAY).schema, kind=kind), source, target, str(tmp_path / "state")).awaitTermination()
        assert ST.current_days(spark, target).count() == 60 - k
    assert [(r.change_kind, r.id_voter) for r in ST.day_changes(spark, target).collect()] == [("removed", "0000000007")]
    assert spark.read.parquet(f"{target}/manifest").count() == 3  # two days, then the changed one


def test_loads_wait_for_their_markers(spark, tmp_path):
    """A load without a marker isn't judged, nor is a later one; once it is there both are, in order."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    day = dt.date(2024, 1, 1)
    load = lambda ids: spark.createDataFrame([(f"{v:010d}", day, "A", "IN-PERSON", "1", v) for v in ids], DAY)
    ST.publish_load(load(range(5)), source, "1")
    (tmp_path / "in" / "markers" / "load=1").rename(tmp_path / "kept")
    run = lambda: ST.ingest_days(ST.day_files(spark, source, load([]).schema), source, target, str(tmp_path / "state")).awaitTermination()
    run()
    assert ST.settle_loads(spark, source, target) == []
    (tmp_path / "kept").rename(tmp_path / "in" / "markers" / "load=1")
    ST.publish_load(load(range(2, 7)), source, "2")
    assert ST.settle_loads(spark, source, target) == ["1"]  # the second load's files aren't in yet
    run()
    assert sorted(r.pos for r in ST.current_days(spark, target).collect()) == [2, 3, 4, 5, 6]
    assert ST.settle_loads(spark, source, target) == []


def test_lines_of_wrong_length_are_rejects(spark, tmp_path):
    path = tmp_path / "day.csv"
    path.write_text('County,Voter_Name,ID_Voter,Voting_Method,Precinct,Extra\nA,"X, ""Y""",12,IN-PERSON,1,e\nB,Z,13\nC,W,14,MAIL-IN,2,,"o, 1",\n,W,15,MAIL-IN,2,e\n')
    rows, rejects = O.validate_roster_rows(I.read_day_lines(spark, str(path)))
    assert [(r.county, r.voter_name, r.id_voter) for r in rows.collect()] == [("A", 'X, "Y"', "0000000012")]
    found = {r.reason: r for r in rejects.collect() if r.raw["county"] != "C"}
    assert found["column_count"].raw == {"county": "B", "voter_name": "Z", "id_voter": "13"} and found["column_count"].overflow == []
    assert found["county:blank"].raw["id_voter"] == "15"
    over = next(r for r in rejects.collect() if r.raw["county"] == "C")
    assert over.reason == "column_count" and over.overflow == ["o, 1", ""] and over.raw["extra"] == ""


def test_ranks_in_two_levels_equal_one_window(spark):
    """A voter with a third of all rows, hashes of both signs, and days without some voters."""
    rnd = random.Random(4)
    rows = [("hot" if k % 3 == 0 else f"v{rnd.randrange(40)}", rnd.randrange(3), rnd.randrange(-(1 << 63), 1 << 63), 0, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "id_voter string, day int, row_hash long, occ int, k int")
    want, last = {}, {}
    for row in sorted(rows, key=lambda r: (r[0], *r[1:4])):
        last[row[0]] = last.get(row[0], 0) + 1
        want[row[4]] = last[row[0]]
    assert {r.k: r["rank"] for r in O.first_appearance_rank(df).collect()} == want
    places = O.ordinal(df.select("id_voter", "k"), [F.col("id_voter"), F.col("k").desc()]).orderBy("place").collect()
    assert [(r.id_voter, -r.k) for r in places] == sorted((r[0], -r[4]) for r in rows) and [r.place for r in places] == list(range(1, 3001))


def test_tables_kept_up_equal_full_builds(spark):
    """Days replaced one after the other: first-seen counts and repeats equal those built from all rows."""
    rows, _ = random_roster(spark, seed=9)
    removals = rows.where("pos % 17 = 0").select("id_voter", "ev_date")
    other = rows.withColumn("id_voter", F.when(F.col("pos") % 4 == 0, F.concat(F.lit("9"), F.substring("id_voter", 2, 9))).otherwise(F.col("id_voter")))
    cells = D.voter_cells(other)
    counts, repeats = D.first_seen_of_cells(cells), D.repeats_of_cells(cells, removals)
    day = dt.date(2024, 1, 2)
    now = other.where(F.col("ev_date") != F.lit(day)).unionByName(rows.where(F.col("ev_date") == F.lit(day)))
    new = D.voter_cells(rows.where(F.col("ev_date") == F.lit(day)))
    touched = D.changed_voters(cells.where(F.col("ev_date") == F.lit(day)), new)
    assert 0 < touched.count() < now.select("id_voter").distinct().count()
    after = D.replaced_days(cells, new, new)
    own = lambda df: df.join(touched, "id_voter", "left_semi")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(D.updated_first_seen(counts, own(cells), own(after))) == key(D.first_seen_counts(now).select("ev_date", "county", "voting_method", "n"))
    assert key(D.updated_repeats(repeats, touched, own(after), removals)) == key(D.repeat_voters(now, removals))
    assert key(D.updated_summary(after, removals)) == key(D.repeat_summary(now, removals))


def test_stored_days_merge_without_shuffling_stored_rows(spark, tmp_path):
    """Loads of a day equal the model's; the stored side has no exchange; other days' files stay as they are."""
    path = f"file://{tmp_path}/days"
    rnd = random.Random(2)
    file = lambda ids: spark.createDataFrame([(1, i, 0, f"c{i}") for i in ids], "day int, row_hash long, occ int, county string")
    model = None
    SD.load_stored_day(spark, path, 2, file(range(5)), 4)
    other = sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "days" / "day=2").rglob("part-*"))
    for version in range(4):
        ids = rnd.sample(range(60), 40)
        assert SD.load_stored_day(spark, path, 1, file(ids), 4) == version + 1
        if model is None:
            model = V.replace_day(file([]).selectExpr("*", "cast(null as int) added_in", "cast(null as int) removed_in"), file(ids), 0)
        else:
            model = V.load_day_version(model, file(ids), version)
        stored = SD.stored_day(spark, path, 1)
        assert sorted(map(str, stored.select(*model.columns).collect())) == sorted(map(str, model.collect()))
    plan = SD.merged_day(stored, file(range(9)), 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert other == sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "days" / "day=2").rglob("part-*"))
    files = [p for p in (tmp_path / "days" / "day=1" / "v=4").rglob("part-*")]
    assert len(files) <= 4  # a file per bucket
    assert SD.on_stored_day(spark, path, 1, lambda df: V.collected(df, 3)) == 5
    assert SD.stored_day(spark, path, 1).where("removed_in <= 3").count() == 0


def test_stored_pages_read_few_files(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    rnd = random.Random(3)
    rows = sorted({(rnd.randrange(-(1 << 63), 1 << 63), rnd.randrange(3)) for _ in range(2000)})
    SD.store_pages(spark.createDataFrame([(*r, "x") for r in rows], "row_hash long, occ int, county string"), path, 20)
    seen, after = [], None
    while page := [(r.row_hash, r.occ) for r in SD.stored_page(spark, path, after, 300).collect()]:
        seen += page
        after = page[-1]
    assert seen == rows
    assert len(SD.stored_page(spark, path, rows[1000], 50).inputFiles()) <= 3
    low, high = rows[200][0], rows[400][0]
    part = SD.stored_range(spark, path, low, high)
    assert sorted((r.row_hash, r.occ) for r in part.collect()) == [r for r in rows if low <= r[0] <= high]
    assert len(part.inputFiles()) <= 4


def test_stored_days_get_buckets_by_their_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SD, "BUCKET_ROWS", 10)
    path = f"file://{tmp_path}/days"
    file = lambda n: spark.range(n).selectExpr("1 day", "id row_hash", "0 occ").selectExpr("cast(day as int) day", "row_hash", "occ")
    versions = [SD.load_stored_day(spark, path, 1, file(n), 2) for n in (35, 35, 300)]
    rows = {r.version: (r.buckets, r.n_rows) for r in SD.stored_days(spark, path).collect()}
    assert versions == [1, 2, 3] and rows == {1: (8, 35), 2: (8, 35), 3: (64, 300)}
    stored = SD.stored_day(spark, path, 1)
    assert {(r.added_in, r["count"]) for r in stored.groupBy("added_in").count().collect()} == {(1, 35), (3, 265)}
    assert len(list((tmp_path / "days" / "day=1" / "v=1").glob("part-*"))) <= 8


def test_first_appearances_of_voters_beyond_one_value(spark, tmp_path):
    """Additions and removals over batches, with state in one value (small = 100) and moved to a map (small = 3)."""
    from tallyframe.queries import _collected_stream, _stateful

    rnd, live, loads = random.Random(5), [], []
    for k in range(4):
        gone = [live.pop(rnd.randrange(len(live))) for _ in range(min(len(live), 8 * (k > 0)))]
        new = [(f"v{rnd.randrange(4)}", rnd.randrange(6), rnd.randrange(3), 0) for _ in range(10 if k < 3 else 0)]
        live += new
        loads.append([(*r, "added") for r in new] + [(*r, "removed") for r in gone])
    own = _stateful(spark)
    schema = "id_voter string, day int, row_hash long, occ int, change string"
    for k, rows in enumerate(loads):
        own.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/load={k}")
    expected = {v: min(r[1:] for r in live if r[0] == v) for v in {r[0] for r in live}}
    for small in (100, 3):
        stream = own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/load=*")
        out = _collected_stream(ST.first_appearances(stream, small), "update")
        last = out.groupBy("id_voter").agg(F.max_by(F.struct("day", "row_hash", "occ"), "batch").alias("x")).where("x.day is not null")
        assert {r.id_voter: tuple(r.x) for r in last.collect()} == expected
