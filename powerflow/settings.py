"""Fixed values of the five supported areas."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: they must equal the published feeds and the existing stores -----------------

# German control areas: join key -> market area code
DE_AREAS = {
    "de": "DE",
    "50hertz": "DE_50HZ",
    "amprion": "DE_AMPRION",
    "tennet": "DE_TENNET",
    "transnetbw": "DE_TRANSNET",
}

# German forecasts: type -> process code
DE_PROCESS_TYPES = {"day_ahead": "A01", "intraday": "A40", "current": "A18"}

# German control areas: join key -> operator name
DE_TSO_NAMES = {
    "50hertz": "50Hertz",
    "amprion": "Amprion",
    "tennet": "TenneT",
    "transnetbw": "TransnetBW",
}

# Installed capacity per German operator, kW
DE_TSO_CAPACITY_KW = {
    "50Hertz": 18_175_000,
    "Amprion": 16_506_000,
    "TenneT": 21_882_000,
    "TransnetBW": 10_770_000,
}

# Default capacity of a Dutch site, kW
NL_SITE_CAPACITY_KW = 20_000_000

# Capacity given to a new location without any seed, W
DEFAULT_LOCATION_WATTS = 100_000_000

# Dutch regions: 0 is the national total
NL_REGION_IDS = list(range(13))

# Rajasthan asset names -> energy type
IND_ASSETS = {"WIND GEN": "wind", "SOLAR GEN": "solar"}

# Retired British grid areas: target -> [(source, weight)]
GB_MERGE_WEIGHTS = {
    4: [(350, 1.0)],
    41: [(343, 1.0), (344, 1.0)],
    56: [(351, 0.27)],
    122: [(351, 0.73)],
    158: [(345, 1.0), (346, 1.0)],
    257: [(348, 1.0), (347, 1.0)],
}

# Highest British grid area taken directly
GB_MAX_ID = 348

# Known locations: (name, latitude, longitude, region id, region, country, type, energy source)
LOCATIONS = [
    ("nl_national", 52.13, 5.29, 0, None, "nl", "NATION", "solar"),
    ("nl_region_1_groningen", 53.22, 6.74, 1, None, "nl", "STATE", "solar"),
    ("nl_region_2_friesland", 53.11, 5.85, 2, None, "nl", "STATE", "solar"),
    ("nl_region_3_drenthe", 52.86, 6.62, 3, None, "nl", "STATE", "solar"),
    ("nl_region_4_overijssel", 52.45, 6.45, 4, None, "nl", "STATE", "solar"),
    ("nl_region_5_flevoland", 52.53, 5.6, 5, None, "nl", "STATE", "solar"),
    ("nl_region_6_gelderland", 52.06, 5.95, 6, None, "nl", "STATE", "solar"),
    ("nl_region_7_utrecht", 52.08, 5.17, 7, None, "nl", "STATE", "solar"),
    ("nl_region_8_noord_holland", 52.58, 4.87, 8, None, "nl", "STATE", "solar"),
    ("nl_region_9_zuid_holland", 51.94, 4.47, 9, None, "nl", "STATE", "solar"),
    ("nl_region_10_zeeland", 51.45, 3.84, 10, None, "nl", "STATE", "solar"),
    ("nl_region_11_noord_brabant", 51.56, 5.2, 11, None, "nl", "STATE", "solar"),
    ("nl_region_12_limburg", 51.21, 5.94, 12, None, "nl", "STATE", "solar"),
    ("be_belgium", 50.85, 4.35, None, "Belgium", "be", "NATION", "solar"),
    ("be_flanders", 51.0, 4.46, None, "Flanders", "be", "STATE", "solar"),
    ("be_wallonia", 50.5, 4.7, None, "Wallonia", "be", "STATE", "solar"),
    ("be_brussels", 50.85, 4.35, None, "Brussels", "be", "STATE", "solar"),
    ("de_national", 51.16, 10.45, None, "de", "de", "NATION", "solar"),
    ("de_50hertz", 52.5, 13.5, None, "50hertz", "de", "STATE", "solar"),
    ("de_amprion", 51.5, 7.5, None, "amprion", "de", "STATE", "solar"),
    ("de_tennet", 51.0, 10.5, None, "tennet", "de", "STATE", "solar"),
    ("de_transnetbw", 48.5, 9.0, None, "transnetbw", "de", "STATE", "solar"),
    ("ruvnl_solar", 26.4499, 74.65, 1, None, "ind_rajasthan", "STATE", "solar"),
    ("ruvnl_wind", 26.4499, 72.65, 2, None, "ind_rajasthan", "STATE", "wind"),
]

# Sites of the site store: country -> [(site key, name, latitude, longitude)]; the Dutch ones are
# the known locations by region
SITES = {
    "nl": [(str(row[3]), row[0], row[1], row[2]) for row in LOCATIONS if row[5] == "nl"],
    "de": [
        ("50Hertz", "50Hertz", 52.53, 13.37),
        ("Amprion", "Amprion", 51.52, 7.45),
        ("TenneT", "TenneT", 52.38, 5.17),
        ("TransnetBW", "TransnetBW", 48.78, 9.18),
    ],
    "ind_rajasthan": [
        ("solar", "runvl_solar_site", 26.4499, 74.65),
        ("wind", "runvl_wind_site", 26.4499, 74.65),
    ],
}

# Column that names the site of a row
SITE_KEYS = {"nl": "region_id", "de": "tso_zone", "ind_rajasthan": "energy_type"}

# Forecaster tag per country
FORECASTER_TAGS = {
    "gb": "neso-solar-forecast",
    "nl": "ned-nl-national",
    "be": "elia-be-forecast",
}

# -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CountryProfile:
    """How the facts of one country find their location and observer."""

    country: str
    id_key: str
    metadata_kind: str
    observer: str | None
    location_types: tuple[str, ...] = ("NATION", "STATE")
    energy_sources: tuple[str, ...] = ("SOLAR",)
    normalise: bool = False
    seeded: bool = True
    observers: tuple[str, ...] = field(default=())

    @property
    def required_observers(self) -> tuple[str, ...]:
        return self.observers or (self.observer,)


# Fixed values as well: observer names, keys and location types of the existing stores
PROFILES = {
    "gb": CountryProfile(
        "gb", "gsp_id", "number", None, ("GSP", "NATION"), seeded=False,
        observers=("pvlive_in_day", "pvlive_day_after"),
    ),
    "nl": CountryProfile("nl", "region_id", "number", "nednl"),
    "nl_no_curtailment": CountryProfile("nl", "region_id", "number", "nednl_no_curtailment"),
    "be": CountryProfile("be", "region", "string", "elia_be", normalise=True),
    "de": CountryProfile("de", "region", "string", "entsoe_de", normalise=True),
    "ind_rajasthan": CountryProfile(
        "ind_rajasthan", "name", "string", "ruvnl", ("STATE",), ("SOLAR", "WIND"),
    ),
}


def profile_for(name: str) -> CountryProfile:
    """Profile by name; an unknown name uses the British one."""
    return PROFILES.get(name, PROFILES["gb"])
