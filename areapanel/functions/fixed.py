"""Names, word lists and constants that results must agree on.

Everything in this file is data, stated plainly in its natural order.
"""

from __future__ import annotations

# Characters stripped around text.
WHITESPACE = " \t\n\r\f\v"

# Tokens that count as missing, one vocabulary per stage.
NULL_TOKENS = {
    "builder": ("",),
    "validator": ("",),
    "static": ("", "NA", "N/A", "NaN", "nan", "None", "null"),
    "inference": ("", "NA", "N/A", "NULL", "null", "NaN", "nan", "None", "#N/A"),
}
# The validator vocabulary is the only one that compares text untrimmed.
UNTRIMMED_VOCABULARIES = ("validator",)

# Words read as booleans.
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")

# Key and identifier columns.
AREA_MONTH = ["area_id", "year", "month"]
ID_COLUMNS = ["area_id", "admin_code", "lat", "lon", "year", "month"]
STATIC_ID_COLUMNS = ["area_id", "admin_code", "lat", "lon"]
IDENTIFIER_COLUMNS = ["ISO3", "country", "country_code", "country_en", "state"]

# Substrings that mark an engineered column (compared in lower case).
ENGINEERED_MARKERS = (
    "__l",
    "__roll",
    "__slope",
    "__accel",
    "__hist_",
    "__forecast_sequence",
    "__delayed_control",
    "__x__",
    "_asof",
    "_lag",
    "lag1",
)

# Outcome columns.
OUTCOME_COLUMNS = [
    "overall_phase",
    "phase1_percent",
    "phase2_percent",
    "phase3_percent",
    "phase4_percent",
    "phase5_percent",
    "estimated_population",
]

# Families of fixed or slowly moving area features.
AEZ_PREFIX = "AEZ_"
AEZ_COLUMNS = [
    "AEZ_4000",
    "AEZ_7000",
    "AEZ_9000",
    "AEZ_10000",
    "AEZ_12000",
    "AEZ_17000",
    "AEZ_19000",
    "AEZ_20000",
    "AEZ_25000",
    "AEZ_28000",
    "AEZ_30000",
    "AEZ_31000",
    "AEZ_32000",
    "AEZ_33000",
    "AEZ_34000",
    "AEZ_35000",
    "AEZ_36000",
    "AEZ_38000",
    "AEZ_40000",
    "AEZ_42000",
    "AEZ_43000",
]
STATIC_FAMILIES = {
    "asap_land_cover": ["crop", "range"],
    "river_distance": ["distance_to_river"],
    "terrain": ["elevation", "ruggedness", "slope"],
    "isric_soilgrids": [
        "sg_cec_5-15cm",
        "sg_cfvo_5-15cm",
        "sg_nitrogen_5-15cm",
        "sg_phh2o_5-15cm",
        "sg_soc_5-15cm",
    ],
    "market_access": ["market_access", "market_distance"],
    "population_context": ["popdensity"],
}
COASTLINE_FEATURE = "coastline_dist"
COASTLINE_FAMILY = "coastline_distance"
COORDINATE_DIGITS = 10

# Event type recodes.
EVENT_RECODES = {
    "Explosions/Remote violence": "explosions",
    "Battles": "battles",
    "Violence against civilians": "violence",
}
EVENT_KINDS = ["battles", "explosions", "violence"]

# Earth radius in kilometres and the default match radius.
EARTH_RADIUS_KM = 6371.0
MATCH_RADIUS_KM = 500.0

# Land-surface variables in band order 1 to 28.
LAND_SURFACE_BANDS = [
    "Evap_tavg",
    "LWdown_f_tavg",
    "Lwnet_tavg",
    "Psurf_f_tavg",
    "Qair_f_tavg",
    "Qg_tavg",
    "Qh_tavg",
    "Qle_tavg",
    "Qs_tavg",
    "Qsb_tavg",
    "RadT_tavg",
    "Rainf_f_tavg",
    "SnowCover_inst",
    "SnowDepth_inst",
    "Snowf_tavg",
    "SoilMoi00_10cm_tavg",
    "SoilMoi10_40cm_tavg",
    "SoilMoi100_200cm_tavg",
    "SoilMoi40_100cm_tavg",
    "SoilTemp00_10cm_tavg",
    "SoilTemp10_40cm_tavg",
    "SoilTemp100_200cm_tavg",
    "SoilTemp40_100cm_tavg",
    "SWdown_f_tavg",
    "SWE_inst",
    "Swnet_tavg",
    "Tair_f_tavg",
    "Wind_f_tavg",
]

# Month column and raster file name patterns.
MONTH_COLUMN_PATTERN = r"^([0-9]{4})(?:_|\.M)([0-9]{2})$"
BAND_COLUMN_PATTERN = r"^([0-9]{4})_([0-9]{2})_B([0-9]+)$"
RASTER_NAME_PATTERNS = {
    "greenness": r"MOD13A3_([0-9]{4})_([0-9]{2})",
    "nightlight": r"nightlight_VIIRS_([0-9]{4})_([0-9]{2})",
    "productivity": r"GOSIF_GPP_([0-9]{4})\.M([0-9]{2})",
}

# Cumulative targets, scopes in months, default threshold, prediction columns.
TARGETS = ["phase2_worse", "phase3_worse", "phase4_worse", "phase5_worse"]
SCOPES = (0, 6, 12)
DEFAULT_THRESHOLD = 0.2
SCORE_COLUMNS = [target + "_score" for target in TARGETS]
PRED_COLUMNS = [target + "_pred" for target in TARGETS]
PREDICTION_COLUMNS = [
    "area_id",
    "year",
    "month",
    "_row_id",
    "phase2_worse_score",
    "phase2_worse_pred",
    "phase3_worse_score",
    "phase3_worse_pred",
    "phase4_worse_score",
    "phase4_worse_pred",
    "phase5_worse_score",
    "phase5_worse_pred",
    "overall_phase_pred",
    "feature_period",
    "target_period",
    "scope_months",
    "model_package_id",
    "source_input",
]

STATIC_FEATURE_COLUMNS = (
    AEZ_COLUMNS + [column for columns in STATIC_FAMILIES.values() for column in columns] + [COASTLINE_FEATURE]
)

# Columns, keys and rules of the named schemas.
SCHEMAS = {
    "historical-panel": {
        "required": ["admin_code", "lat", "lon", "year", "month"] + OUTCOME_COLUMNS,
        "nonblank": ["admin_code", "lat", "lon", "year", "month"],
        "key": ["admin_code", "lat", "lon", "year", "month"],
        "outcomes": True,
        "same_id": False,
    },
    "forecast-scaffold": {
        "required": ["admin_code", "lat", "lon", "year", "month"],
        "nonblank": ["admin_code", "lat", "lon", "year", "month"],
        "key": ["admin_code", "lat", "lon", "year", "month"],
        "outcomes": False,
        "same_id": False,
    },
    "fixed-slow-area": {
        "required": ["area_id", "admin_code", "lat", "lon"] + STATIC_FEATURE_COLUMNS,
        "nonblank": ["area_id", "admin_code", "lat", "lon"],
        "key": ["area_id"],
        "outcomes": False,
        "same_id": True,
    },
    "model-input-training": {
        "required": ["area_id", "year", "month"] + OUTCOME_COLUMNS,
        "nonblank": ["area_id", "year", "month"] + OUTCOME_COLUMNS,
        "key": ["area_id", "year", "month"],
        "outcomes": True,
        "same_id": False,
    },
    "model-input-forecast": {
        "required": ["area_id", "year", "month"],
        "nonblank": ["area_id", "year", "month"],
        "key": ["area_id", "year", "month"],
        "outcomes": False,
        "same_id": False,
    },
}
