"""Fixed schemas and fixed domain values."""

from pyspark.sql import types as T

# --- Fixed values: they must equal the published data model for right results ---

# Zone centroids, (latitude, longitude) in degrees.
ZONES = {
    "SE1": (62.0, 14.5),
    "SE2": (62.5, 17.5),
    "SE3": (59.5, 18.0),
    "SE4": (56.0, 14.0),
    "NO1": (59.5, 10.5),
    "NO2": (64.0, 11.5),
    "DK1": (56.5, 9.5),
    "DK2": (55.5, 12.0),
    "FI": (61.5, 25.0),
}

# Control areas at which generation is published, and the load zones inside each.
# Every other zone is its own area.
AREA_OF_ZONE = {
    "SE1": "SE",
    "SE2": "SE",
    "SE3": "SE",
    "SE4": "SE",
    "NO1": "NO",
    "NO2": "NO",
}

# EIC codes that may appear instead of a short code.
EIC_REGION = {
    "10Y1001A1001A44P": "SE1",
    "10Y1001A1001A45N": "SE2",
    "10Y1001A1001A46L": "SE3",
    "10Y1001A1001A47J": "SE4",
    "10YNO-1--------2": "NO1",
    "10YNO-2--------T": "NO2",
    "10YDK-1--------W": "DK1",
    "10YDK-2--------M": "DK2",
    "10YFI-1--------U": "FI",
    "10YSE-1--------K": "SE",
    "10YNO-0--------C": "NO",
}

# Values of `variable` in the long energy form.
ONSHORE = "B19"
OFFSHORE = "B18"
LOAD = "load_mwh"

HORIZONS = (24, 48, 72)
THRESHOLD_MPS = 3.0
CVAR_ALPHA = 0.05
QUANTILES = (0.10, 0.50, 0.90)
ALERT_PROBABILITY = 0.9
AT_RISK_PROBABILITY = 0.1
PRICE_SPIKE_EUR = 200.0
TEMPORAL_SCALE_H = 168.0
EARTH_RADIUS_KM = 6371.0

# --- End of fixed values ---

REGIONS = sorted({*ZONES, *AREA_OF_ZONE.values()})

WEATHER = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("wind_speed_mps", T.DoubleType()),
])

GRID = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("u10", T.DoubleType()),
    T.StructField("v10", T.DoubleType()),
])

ENERGY_LONG = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("value_mwh", T.DoubleType()),
])

ENERGY = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("wind_onshore_mwh", T.DoubleType()),
    T.StructField("wind_offshore_mwh", T.DoubleType()),
    T.StructField("total_load_mwh", T.DoubleType()),
])

FORECAST = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("horizon_h", T.IntegerType()),
    T.StructField("p_shortfall", T.DoubleType()),
    T.StructField("cvar_shortfall", T.DoubleType()),
    T.StructField("wind_p10", T.DoubleType()),
    T.StructField("wind_p50", T.DoubleType()),
    T.StructField("wind_p90", T.DoubleType()),
])

RUN_METRICS = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("text", T.StringType()),
])
