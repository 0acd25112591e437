"""Column names and types of the frames that operators exchange."""

from __future__ import annotations

# Voting history columns of the register, newest first in each kind.
HISTORY = ("GEN24", "GEN23", "GEN22", "GEN21", "GEN20", "GEN19", "GEN18", "PRI26", "PRI24", "PRI22", "PRI20", "PRI18", "RO26", "RO24", "RO22", "RO20", "RO18")
PRESIDENTIAL = ("GEN24", "GEN20")
MIDTERM = ("GEN22", "GEN18")
OFF_YEAR = ("GEN23", "GEN21", "GEN19")
PRIMARIES = ("PRI26", "PRI24", "PRI22", "PRI20", "PRI18", "RO26", "RO24", "RO22", "RO20", "RO18")
REGISTER_COLUMNS = ("VUID", "SEX", "DOB", "EDR", *HISTORY)
# Codes that a history cell may hold.
GENERAL_CODES = ("V", "VE", "VA")
PRIMARY_CODES = ("D", "R", "DE", "RE", "DA", "RA")
SEXES = ("F", "M", "U")
# Key, election date, early days, first early day, whether it is the current one, ids.
CALENDAR = (
    ("GEN25", "2025-11-04", 12, "2025-10-20", False, (51031,)),
    ("PRI26", "2026-03-03", 11, "2026-02-17", False, (53813, 53814)),
    ("RO26", "2026-05-26", 5, "2026-05-18", False, (58314, 58315)),
    ("GEN26", "2026-11-03", 17, "2026-10-14", True, (53815,)),
)
# Age tiers (from, to, label, order) and age brackets (from, to, label).
AGE_TIERS = ((18, 24, "18-24", 1), (25, 34, "25-34", 2), (35, 54, "35-54", 3), (55, 64, "55-64", 4), (65, 74, "65-74", 5), (75, 84, "75-84", 6), (85, 200, "85+", 7))
AGE_BRACKETS = ((18, 24, "18-24"), (25, 34, "25-34"), (35, 44, "35-44"), (45, 54, "45-54"), (55, 64, "55-64"), (65, 74, "65-74"), (75, 999, "75+"))

# Columns of the files, in their order.
ROSTER_CSV = ("id_voter", "voting_method", "precinct", "county", "election_id", "report_date", "voter_name", "duplicate_flag", "duplicate_type", "also_found_on")
ENRICHED_CSV = ("in_voterfile", "cd", "hd", "sd", "vf_county", "vf_precinct", "age_bracket", "sex", "hispanic", "status")
TURNOUT_CSV = {
    "election_id": "string",
    "report_date": "date",
    "county": "string",
    "county_id": "string",
    "registered_voters": "long",
    "in_person_votes_on_date": "long",
    "total_in_person_votes": "long",
    "total_mail_votes": "long",
    "roster_available": "boolean",
    "source": "string",
}
DAY_ROSTER = ("COUNTY", "VOTER_NAME", "ID_VOTER", "VOTING_METHOD", "PRECINCT")

# Fields of the payloads.
TURNOUT_JSON = (
    "election_id string, early_voting_date string, "
    "turnout_by_county array<struct<name: string, id: string, registered_voters: long, in_person_votes_on_date: long, total_in_person_votes_for_election: long, total_mail_votes_for_election: long, voter_details_report: string>>"
)
ELECTIONS_JSON = (
    "elections array<struct<id: string, type: string, election_date: string, election_name: string, certified: boolean, "
    "early_voting_dates array<struct<date: string, date_turnout_id: string>>, counties: array<struct<county_id: string, name: string>>>>"
)
CONSTANTS_JSON = "electionInfo map<string, map<string, map<string, struct<ID: string, N: string>>>>"
OFFICE_JSON = "OS array<struct<OID: string, ON: string, C: array<struct<N: string, P: string, T: long, O: long>>>>"
COUNTY_JSON = "map<string, struct<N: string, Summary: struct<RV: long>, Races: map<string, struct<C: map<string, struct<N: string, V: long, EV: long>>>>>>"
GEO_JSON = (
    "areas array<struct<kind: string, code: string, name: string, lat: double, lon: double, south: double, west: double, north: double, east: double>>, "
    "precincts array<struct<pctkey: string, county_fips: string, prec: string, cd: string, sd: string, hd: string, split_cd: boolean, split_sd: boolean, split_hd: boolean>>"
)
