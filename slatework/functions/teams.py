"""Team spellings, one map per canonical form, and team-keyed lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatework.functions.coerce import literal_map

# The retro-style codes used by ingest tables. Letters only.
RETRO = {
    "AZ": "ARI", "CUBS": "CHC", "CWS": "CHA", "CHW": "CHA", "WHITESOX": "CHA",
    "KC": "KCA", "KCR": "KCA", "ANA": "LAA", "LAD": "LAN", "FLA": "MIA",
    "NYY": "NYA", "NYYANKEES": "NYA", "NYM": "NYN", "NYMETS": "NYN", "ATH": "OAK",
    "SD": "SDN", "SDP": "SDN", "SF": "SFN", "SFG": "SFN", "STL": "SLN", "SL": "SLN",
    "TB": "TBA", "TBR": "TBA", "TAMPABAY": "TBA", "WSH": "WAS", "NATS": "WAS",
}
# Codes used by the game spine.
SPINE = {
    "AZ": "ARI", "ARZ": "ARI", "ATH": "OAK", "OAKLAND": "OAK", "CWS": "CHW", "CHIWS": "CHW",
    "KCR": "KC", "KAN": "KC", "SDP": "SD", "SFG": "SF", "TBR": "TB", "TAM": "TB", "WAS": "WSH",
}
# Codes used by live lineup and starter feeds.
LIVE = {
    "AZ": "ARI", "ARZ": "ARI", "ATH": "OAK", "CWS": "CHW", "KCR": "KC", "KAN": "KC",
    "SDP": "SD", "SFG": "SF", "TBR": "TB", "TAM": "TB", "WAS": "WSH",
}
# Codes used by lineup pages.
PAGE = {
    "AZ": "ARI", "CWS": "CHW", "KCR": "KC", "ATH": "OAK", "SDP": "SD", "SFG": "SF",
    "TBR": "TB", "WAS": "WSH",
}
# Codes used by contact-quality game tables.
CONTACT = {
    "ATHLETICS": "OAK", "A'S": "OAK", "WSH": "WSN", "WAS": "WSN", "D-BACKS": "ARI", "AZ": "ARI",
}
# Codes used by feature views.
FEATURE = {"ATH": "OAK", "AZ": "ARI", "WSN": "WSH", "WAS": "WSH", "CWS": "CHW"}

# The thirty codes a lineup page may show.
PAGE_TEAMS = [
    "ARI", "ATL", "BAL", "BOS", "CHC", "CHW", "CIN", "CLE", "COL", "DET", "HOU", "KC", "LAA",
    "LAD", "MIA", "MIL", "MIN", "NYM", "NYY", "OAK", "PHI", "PIT", "SD", "SEA", "SF", "STL",
    "TB", "TEX", "TOR", "WSH",
]

# Home team to weather station.
STATIONS = {
    "ARI": "KPHX", "AZ": "KPHX", "ATL": "KATL", "BAL": "KBWI", "BOS": "KBOS", "CHC": "KORD",
    "CHA": "KMDW", "CHW": "KMDW", "CWS": "KMDW", "CIN": "KLUK", "CLE": "KCLE", "COL": "KDEN",
    "DET": "KDTW", "HOU": "KIAH", "KCA": "KMCI", "KC": "KMCI", "KCR": "KMCI", "LAA": "KSNA",
    "LAD": "KLAX", "LAN": "KLAX", "MIA": "KMIA", "MIL": "KMKE", "MIN": "KMSP", "NYA": "KLGA",
    "NYY": "KLGA", "NYN": "KLGA", "NYM": "KLGA", "OAK": "KOAK", "ATH": "KOAK", "PHI": "KPHL",
    "PIT": "KPIT", "SD": "KSAN", "SDN": "KSAN", "SDP": "KSAN", "SEA": "KSEA", "SF": "KSFO",
    "SFN": "KSFO", "SFG": "KSFO", "SLN": "KSTL", "STL": "KSTL", "TBA": "KTPA", "TB": "KTPA",
    "TBR": "KTPA", "TEX": "KDFW", "TOR": "CYYZ", "WAS": "KDCA", "WSH": "KDCA",
}

# Home parks whose roof can close.
ROOFED = ["ARI", "AZ", "HOU", "MIA", "MIL", "SEA", "TBA", "TB", "TOR", "TEX"]

# Park factors by home team: home run, run, single, double/triple.
PARK_COLUMNS = ["park_hr_factor", "park_run_factor", "park_1b_factor", "park_2b3b_factor"]
PARK_FACTORS = {
    "ARI": (1.03, 1.01, 1.00, 1.03),
    "ATL": (1.02, 1.01, 0.99, 1.00),
    "BAL": (1.05, 1.01, 0.99, 1.01),
    "BOS": (1.04, 1.02, 1.01, 1.08),
    "CHC": (1.00, 1.00, 1.00, 1.00),
    "CHW": (1.03, 1.01, 1.00, 1.00),
    "CIN": (1.18, 1.07, 0.98, 0.97),
    "CLE": (0.96, 0.98, 1.00, 1.00),
    "COL": (1.30, 1.18, 1.08, 1.15),
    "DET": (0.90, 0.95, 1.00, 1.05),
    "HOU": (0.97, 0.99, 0.99, 1.00),
    "KC": (0.92, 0.97, 1.03, 1.07),
    "LAA": (1.04, 1.01, 0.99, 1.00),
    "LAD": (1.02, 1.01, 1.00, 1.00),
    "MIA": (0.92, 0.95, 1.00, 1.00),
    "MIL": (1.06, 1.03, 0.99, 0.99),
    "MIN": (1.02, 1.01, 0.99, 1.01),
    "NYM": (0.93, 0.96, 1.00, 0.98),
    "NYY": (1.14, 1.03, 0.98, 0.96),
    "OAK": (0.98, 0.98, 1.00, 1.00),
    "PHI": (1.08, 1.04, 0.99, 1.00),
    "PIT": (0.96, 0.97, 1.00, 1.02),
    "SD": (0.90, 0.94, 1.01, 1.01),
    "SEA": (0.95, 0.96, 0.99, 1.00),
    "SF": (0.90, 0.94, 1.00, 1.04),
    "STL": (0.94, 0.97, 1.00, 1.00),
    "TB": (0.92, 0.95, 0.99, 1.00),
    "TEX": (1.08, 1.05, 1.00, 1.02),
    "TOR": (1.00, 1.00, 1.00, 1.00),
    "WSH": (1.00, 1.00, 1.00, 1.00),
}


def lookup(key: Column, values: dict[str, str], overrides: dict[str, str] | None = None) -> Column:
    """Value of a constant dictionary, null when the key is absent."""
    table = literal_map({**values, **(overrides or {})})
    return F.when(key.isNotNull(), F.try_element_at(table, key))


def team_code(value: Column, aliases: dict[str, str]) -> Column:
    """Upper, trim, replace a known alias; unknown codes pass through."""
    token = F.upper(F.trim(value))
    return F.coalesce(lookup(token, aliases), token)


def team_code_letters(value: Column, aliases: dict[str, str] = RETRO) -> Column:
    """As ``team_code`` but only letters count, and an empty code is null."""
    token = F.regexp_replace(F.upper(F.trim(value)), "[^A-Z]", "")
    return F.when(token != "", F.coalesce(lookup(token, aliases), token))


def station_of(team: Column, overrides: dict[str, str] | None = None) -> Column:
    fixed = {k: v.upper() for k, v in (overrides or {}).items()}
    return lookup(team, STATIONS, fixed)


def roof_class(team: Column) -> Column:
    roofed = F.coalesce(team.isin(ROOFED), F.lit(False))
    return F.when(roofed, "unknown_retractable").otherwise("open_air")


def park_factor_columns(team: Column) -> list[Column]:
    """The four factors of a home team, 1.0 when it is unknown or null."""
    table = literal_map(PARK_FACTORS, "map<string,array<double>>")
    row = F.when(team.isNotNull(), F.try_element_at(table, team))
    return [
        F.coalesce(F.get(row, i), F.lit(1.0)).alias(name) for i, name in enumerate(PARK_COLUMNS)
    ]
