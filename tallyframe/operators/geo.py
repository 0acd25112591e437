"""Geography of voters: precinct aliases, placement, points and districts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.scalars import county_key, district_key, pack_bits, zfill

LAYERS = ("cd", "sd", "hd")


def county_name_join(rows: DataFrame, counties: DataFrame) -> DataFrame:
    """JON21: ``rows`` with county_fips from ``counties`` (name, fips), by the letters of the name."""
    keyed = counties.select(county_key("name").alias("__key"), F.col("fips").alias("county_fips"))
    return rows.withColumn("__key", county_key("county")).join(keyed, "__key", "left").drop("__key")


def pair_counts(rows: DataFrame) -> DataFrame:
    """AGG16: rows per (county, precinct)."""
    return rows.groupBy("county", "precinct").agg(F.count("*").alias("n"))


def resolve_alias(pairs: DataFrame, precincts: DataFrame) -> DataFrame:
    """JON08: pctkey and rule of each pair (county_fips, precinct): the text as it is, then four digits,
    then letters and digits padded to four, else unmatched. One join on all candidates; the first rule wins."""
    text = F.coalesce("precinct", F.lit(""))
    bare = F.trim(text)
    digits = F.when(F.rlike(bare, F.lit("^[0-9]+$")), zfill(bare, 4))
    mixed = F.when(F.rlike(bare, F.lit("^[0-9]+[A-Za-z]+$")), F.upper(zfill(bare, 4)))
    rules = (("exact", text), ("zfill4", digits), ("alnum_zfill4", mixed))
    tries = F.array(*[F.struct(F.lit(i).alias("order"), F.lit(rule).alias("rule"), code.alias("code")) for i, (rule, code) in enumerate(rules)])
    tried = pairs.withColumn("__try", F.explode(F.filter(tries, lambda x: x["code"].isNotNull() & (F.trim(x["code"]) != ""))))
    known = precincts.select(F.col("county_fips").alias("__fips"), F.col("prec").alias("__prec"), "pctkey")
    found = tried.join(known, (F.col("county_fips") == F.col("__fips")) & (F.col("__try.code") == F.col("__prec")))
    best = found.groupBy("county_fips", "precinct").agg(F.min(F.struct(F.col("__try.order").alias("o"), F.col("pctkey"), F.col("__try.rule").alias("rule"))).alias("b"))
    own = best.select(F.col("county_fips").alias("__f"), F.col("precinct").alias("__p"), "b.pctkey", "b.rule")
    out = pairs.join(own, pairs["county_fips"].eqNullSafe(own["__f"]) & pairs["precinct"].eqNullSafe(own["__p"]), "left").drop("__f", "__p")
    return out.withColumn("rule", F.coalesce("rule", F.lit("unmatched")))


def alias_coverage(resolved: DataFrame) -> DataFrame:
    """AGG17: rule, pairs, rows, and a row ``all`` with matched pairs and rows and their share."""
    by_rule = resolved.groupBy("rule").agg(F.count("*").alias("pairs"), F.sum("n").alias("rows"), F.count("pctkey").alias("matched_pairs"), F.sum(F.when(F.col("pctkey").isNotNull(), F.col("n")).otherwise(0)).alias("matched_rows"))
    everything = resolved.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count("pctkey"), F.coalesce(F.sum(F.when(F.col("pctkey").isNotNull(), F.col("n"))), F.lit(0)))
    out = by_rule.union(everything.select(F.lit("all"), "*"))
    return out.withColumn("share", F.when(F.col("rows") > 0, F.col("matched_rows") / F.col("rows")).otherwise(0.0))


def county_sole_districts(precincts: DataFrame) -> DataFrame:
    """AGG19: per county and layer the one district that all its precincts have, if none is split."""
    def sole(layer: str) -> Column:
        split = F.max(F.coalesce(f"split_{layer}", F.lit(False)))
        value = F.coalesce(layer, F.lit("~"))
        return F.when((F.min(value) == F.max(value)) & ~split & (F.max(value) != "~"), F.max(value)).alias(f"sole_{layer}")

    return precincts.groupBy("county_fips").agg(*map(sole, LAYERS))


def place_voters(first_rows: DataFrame, resolved: DataFrame, precincts: DataFrame) -> DataFrame:
    """JON09: id_voter, pctkey, alias state, districts and split bits.

    A matched alias gives its precinct's districts and split bits (1 cd, 2 sd, 4 hd); an unmatched one, or
    none, the districts that the whole county has (``county_sole_districts``)."""
    alias = resolved.select("county_fips", "precinct", "pctkey", F.lit(True).alias("__known"))
    a = alias.withColumnsRenamed({"county_fips": "__f", "precinct": "__p"})
    joined = first_rows.join(a, first_rows["county_fips"].eqNullSafe(a["__f"]) & first_rows["precinct"].eqNullSafe(a["__p"]), "left").drop("__f", "__p")
    own = precincts.select("pctkey", *[F.col(x).alias(f"__{x}") for x in LAYERS], pack_bits(*[F.col(f"split_{x}") for x in LAYERS]).alias("split_flag"))
    joined = joined.join(own, "pctkey", "left").join(county_sole_districts(precincts), "county_fips", "left")
    state = F.when(F.col("pctkey").isNotNull(), "matched").when(F.col("__known"), "unmatched_alias").otherwise("no_alias")
    districts = [F.when(F.col("pctkey").isNotNull(), F.col(f"__{x}")).otherwise(F.col(f"sole_{x}")).alias(x) for x in LAYERS]
    return joined.select("id_voter", "county_fips", "pctkey", state.alias("alias_state"), *districts, "split_flag")


def voter_geo_tally(placed: DataFrame) -> DataFrame:
    """AGG18: counters of a build in one pass: voters, by alias state, with districts, split, and placed
    voters without a district."""
    here = F.col("pctkey").isNotNull()
    counts = {"voters": F.count("*"), **{s: F.count_if(F.col("alias_state") == s) for s in ("matched", "unmatched_alias", "no_alias")}, "no_county": F.count_if(F.col("county_fips").isNull())}
    counts |= {f"with_{x}": F.count(x) for x in LAYERS} | {f"null_{x}": F.count_if(here & F.col(x).isNull()) for x in LAYERS} | {f"split_{x}": F.count_if(F.coalesce(F.col("split_flag").bitwiseAND(1 << i) > 0, F.lit(False))) for i, x in enumerate(LAYERS)}
    return placed.agg(*[c.alias(k) for k, c in counts.items()])


def voter_geo_page(day: DataFrame, geo: DataFrame, points: DataFrame) -> DataFrame:
    """JON10, DED07: the distinct voters of a day with districts: the point's where there is a point, even
    null ones, else the precinct's. matched_at: the later of the two."""
    g = geo.select("id_voter", *[F.col(x).alias(f"g_{x}") for x in LAYERS], F.col("matched_at").alias("g_at"))
    p = points.select("id_voter", F.lit(True).alias("p_here"), *[F.col(x).alias(f"p_{x}") for x in LAYERS], F.col("matched_at").alias("p_at"))
    out = day.select("id_voter").dropDuplicates(["id_voter"]).join(g, "id_voter", "left").join(p, "id_voter", "left")
    return out.select("id_voter", *[F.when(F.col("p_here"), F.col(f"p_{x}")).otherwise(F.col(f"g_{x}")).alias(x) for x in LAYERS], F.greatest("g_at", "p_at").alias("matched_at"))


def precinct_points(aliases: DataFrame, areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JON11: matched aliases with their precinct's point and box (null if an edge is), and the number of
    those without one."""
    known = areas.where("kind = 'precinct'")
    box = F.when(F.col("south").isNotNull() & F.col("west").isNotNull() & F.col("north").isNotNull() & F.col("east").isNotNull(), F.concat_ws(",", *[F.col(c).cast("string") for c in ("south", "west", "north", "east")]))
    found = aliases.where("pctkey is not null").join(known, F.col("pctkey") == F.col("code")).select("county", "precinct", "pctkey", "lat", "lon", box.alias("box")).orderBy("county", "precinct")
    matched = found.agg(F.count("*").alias("matched"))
    return found, aliases.agg(F.count("*").alias("total")).crossJoin(F.broadcast(matched)).select((F.col("total") - F.col("matched")).alias("unmatched"))


def point_vs_precinct(points: DataFrame, geo: DataFrame) -> DataFrame:
    """JON17, AGG25: per layer the voters whose point's district agrees with, differs from or lacks the
    precinct's, and voters with a precinct but no point. Codes are compared trimmed, without zeros in
    front; rows without a precinct are left out."""
    both = geo.where("pctkey is not null").select("id_voter", *[F.col(x).alias(f"g_{x}") for x in LAYERS]).join(points.select("id_voter", F.lit(True).alias("here"), *LAYERS), "id_voter", "left")
    def outcome(x: str) -> Column:
        a, b = district_key(x), district_key(f"g_{x}")
        return F.when(F.col("here").isNull(), "no_point").when(a.isNull() | b.isNull(), "not_comparable").when(a == b, "agree").otherwise("disagree")

    parts = F.array(*[F.struct(F.lit(x).alias("layer"), outcome(x).alias("outcome")) for x in LAYERS])
    return both.select(F.explode(parts).alias("x")).select("x.*").groupBy("layer").pivot("outcome", ["agree", "disagree", "not_comparable", "no_point"]).count().na.fill(0)


def address_point_match(voters: DataFrame, addresses: DataFrame) -> DataFrame:
    """JON18: voters (id_voter, county, address) at address points (county, address, lat, lon).

    Addresses are compared upper-cased, with single spaces and without points and commas, within a county;
    keys with several different points match nothing."""
    key = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), "[.,#]", " "), r"\s+", " "))
    one = addresses.withColumn("__key", key("address")).groupBy("county", "__key").agg(F.min(F.struct("lat", "lon")).alias("a"), F.max(F.struct("lat", "lon")).alias("b")).where("a = b")
    return voters.withColumn("__key", key("address")).where("__key != ''").join(one, ["county", "__key"]).select("id_voter", "county", F.col("a.lat").alias("lat"), F.col("a.lon").alias("lon"))


def polygon_cells(districts: DataFrame, cell: float) -> DataFrame:
    """district, cx, cy, edges of the grid cells that a district's ring meets or encloses (``ring``: array of structs x, y, not
    closed). Cells that no edge passes through are whole: inside ones have null edges, outside ones aren't there. An edge
    cell has the edges of its row of cells that don't end left of it: all that a ray to the right can cross."""
    after = F.concat(F.slice("ring", F.lit(2), F.size("ring")), F.slice("ring", F.lit(1), F.lit(1)))
    edges = districts.select("district", F.explode(F.zip_with("ring", after, lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))).alias("e"))
    at = lambda c: F.floor(c / cell)
    low, high = F.least("e.ay", "e.by"), F.greatest("e.ay", "e.by")
    rows = edges.withColumn("cy", F.explode(F.sequence(at(low), at(high))))
    # where the edge is inside its row of cells; a margin makes up for rounding
    slope = (F.col("e.bx") - F.col("e.ax")) / F.nullif(F.col("e.by") - F.col("e.ay"), F.lit(0.0))
    x_at = lambda y: F.col("e.ax") + (y - F.col("e.ay")) * slope
    ends = [F.coalesce(x_at(F.greatest(low, F.col("cy") * cell)), F.col("e.ax")), F.coalesce(x_at(F.least(high, (F.col("cy") + 1) * cell)), F.col("e.bx"))]
    rows = rows.withColumn("from", at(F.least(*ends) - cell * 1e-6)).withColumn("to", at(F.greatest(*ends) + cell * 1e-6))
    bands = rows.groupBy("district", "cy").agg(F.collect_list("e").alias("band"), F.min("from").alias("from"), F.max("to").alias("to"))
    touched = rows.select("district", "cy", F.explode(F.sequence("from", "to")).alias("cx")).distinct().withColumn("edge", F.lit(True))
    cells = bands.withColumn("cx", F.explode(F.sequence("from", "to"))).join(touched, ["district", "cy", "cx"], "left")
    cells = cells.withColumn("lon", (F.col("cx") + 0.5) * cell).withColumn("lat", (F.col("cy") + 0.5) * cell)
    near = F.filter("band", lambda e: F.greatest(e["ax"], e["bx"]) >= F.col("cx") * cell)
    kept = cells.where(F.col("edge") | _inside(F.col("band"), F.col("lon"), F.col("lat")))
    return kept.select("district", "cx", "cy", F.when(F.col("edge"), near).alias("edges"))


def _inside(edges: Column, lon: Column, lat: Column) -> Column:
    """Whether a ray to the right crosses an odd number of edges."""

    def crosses(n: Column, e: Column) -> Column:
        over = (e["ay"] > lat) != (e["by"] > lat)
        at = (e["bx"] - e["ax"]) * (lat - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]
        return n + F.when(over & (lon < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), crosses) % 2 == 1


def point_in_polygon(points: DataFrame, districts: DataFrame, cell: float = 0.25) -> DataFrame:
    """JON19: id_voter and district (the least, if several) of each point (lat, lon) in ``districts``
    (district, ring: array of structs x, y, not closed).

    Points meet the cells of ``polygon_cells`` by an equi-join; edges are counted in edge cells only, and there only those of
    the cell's row. A point on a lower or left edge is inside, on an upper or right one outside."""
    spots = points.withColumn("cx", F.floor(F.col("lon") / cell)).withColumn("cy", F.floor(F.col("lat") / cell))
    pairs = spots.join(polygon_cells(districts, cell), ["cx", "cy"])
    found = pairs.where(F.col("edges").isNull() | _inside(F.col("edges"), F.col("lon"), F.col("lat")))
    return found.groupBy("id_voter").agg(F.min("district").alias("district"))


def largest_overlap(overlaps: DataFrame, totals: DataFrame) -> DataFrame:
    """JON20, WIN07: per precinct the district of the largest overlap, its share and whether it is split.

    Overlaps within 1e-9 of the largest tie, and the lowest district number wins; share: top / total, 1 at
    most, four decimals; split below 0.99. Precincts without overlap are left out."""
    top = F.max("area").over(Window.partitionBy("precinct"))
    best = overlaps.where("area > 0").withColumn("top", top).where(F.col("area") >= F.col("top") * (1 - 1e-9)).groupBy("precinct").agg(F.min(F.col("district").cast("int")).alias("district"), F.max("area").alias("top"))
    share = F.least(F.lit(1.0), F.col("top") / F.col("total"))
    return best.join(totals, "precinct").select("precinct", "district", F.bround(share, 4).alias("share"), (share < 0.99).alias("split"))


def bounding_box(vertices: DataFrame, areas: DataFrame) -> DataFrame:
    """AGG26: per area the box of its vertices (code, lat, lon), widened to its point, six decimals."""
    box = vertices.groupBy("code").agg(F.min("lat").alias("s"), F.min("lon").alias("w"), F.max("lat").alias("n"), F.max("lon").alias("e"))
    edge = lambda f, a, b: F.bround(f(a, b), 6)
    return areas.join(box, "code", "left").select("code", edge(F.least, "s", "lat").alias("south"), edge(F.least, "w", "lon").alias("west"), edge(F.greatest, "n", "lat").alias("north"), edge(F.greatest, "e", "lon").alias("east"))
