"""Declared schemas and the fixed values results depend on.

The names, keys, labels and thresholds below must stay exactly as they are:
they define the wire format, the table layout and the labels users see.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must not change)
# ---------------------------------------------------------------------------

# Raw CSV / message field names, in file order.
RAW_TIME = "Date/Time"
RAW_ACTIVE_POWER = "LV ActivePower (kW)"
RAW_WIND_SPEED = "Wind Speed (m/s)"
RAW_POWER_CURVE = "Theoretical_Power_Curve (KWh)"
RAW_WIND_DIRECTION = "Wind Direction (°)"
RAW_FIELDS = [RAW_TIME, RAW_ACTIVE_POWER, RAW_WIND_SPEED, RAW_POWER_CURVE, RAW_WIND_DIRECTION]

# Keys of the ``signals`` map, paired with the raw field each one comes from.
SIGNAL_KEYS = ["ActivePower_kW", "WindSpeed_m_s", "PowerCurve_kWh", "WindDirection_deg"]
SIGNAL_SOURCES = {
    "ActivePower_kW": RAW_ACTIVE_POWER,
    "WindSpeed_m_s": RAW_WIND_SPEED,
    "PowerCurve_kWh": RAW_POWER_CURVE,
    "WindDirection_deg": RAW_WIND_DIRECTION,
}

# Generation bands on the hourly mean active power (kW):
# below 200 Low; 200 up to 600 Medium; 600 up to 1000 High; otherwise Exceptional
# (the otherwise branch also takes null and NaN means).
BANDS = [(200.0, "Low"), (600.0, "Medium"), (1000.0, "High")]
BAND_ABOVE = "Exceptional"

# Signal-name mapping rows (sig_name -> sig_mapping_name), in table order.
SIGNAL_MAPPING = [
    ("avg_ActivePower_kW", "active_power_average"),
    ("avg_WindSpeed_m_s", "wind_speed_average"),
    ("avg_PowerCurve_kWh", "theo_power_curve_average"),
    ("avg_WindDirection_deg", "wind_direction_average"),
    ("generation_indicator", "generation_mapping"),
]
# Older mapping variant: the label column was called generation_status.
SIGNAL_MAPPING_LEGACY_LABEL = ("generation_indicator", "generation_status")

# Regression set-up: label, features, split and the scoring day.
LR_LABEL = "active_power_average"
LR_FEATURES = [
    "wind_speed_average",
    "theo_power_curve_average",
    "wind_direction_average",
    "generation_status_index",
]
# The band index is derived from the label itself (target leakage); this list
# leaves it out.
LR_FEATURES_NO_LEAK = LR_FEATURES[:3]
LR_SPLIT_WEIGHTS = [0.8, 0.2]
LR_SPLIT_SEED = 42
LR_SCORE_DAY = "2018-01-19"

# Intent router: lower-case substring keywords that send a conversation to
# venue search; everything else goes to general chat.
ROUTER_KEYWORDS = [
    "find", "search", "look", "show", "venue", "hall", "location",
    "budget", "guest", "capacity", "wedding", "reception", "ceremony",
    "luxury", "cheap", "affordable", "outdoor", "indoor", "garden",
]
ROUTE_SEARCH = "search_venues_node"
ROUTE_GENERAL = "general_chat_node"

# Venue-record defaults used when a field is missing.
CONTACT_DEFAULT = "Contact for details"
DEFAULT_LOCATION = "Mumbai, Maharashtra"
MAX_RESULTS_PER_SOURCE = 6

# Fallback venue record used when a search returns nothing.
FALLBACK_VENUE = {
    "name": "Grand Palace Wedding Hall",
    "capacity": "200-500 guests",
    "priceRange": "₹8,000 - ₹15,000",
    "rating": 4.8,
    "description": "Luxurious wedding hall with stunning architecture and world-class amenities",
    "image": "https://images.pexels.com/photos/169190/pexels-photo-169190.jpeg",
    "phone": "+91 98765 43210",
    "email": "events@grandpalace.com",
    "amenities": ["Valet Parking", "Catering Services", "Bridal Suite", "Audio/Visual Equipment"],
    "features": ["Grand Ballroom", "Garden Ceremony Area", "VIP Lounge", "Dance Floor"],
}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# Raw CSV reading: time as text, four doubles.
RAW_CSV_SCHEMA = StructType(
    [StructField(RAW_TIME, StringType(), True)]
    + [StructField(f, DoubleType(), True) for f in RAW_FIELDS[1:]]
)

# Parsed message: the same five names, all read as text.
MESSAGE_SCHEMA = StructType([StructField(f, StringType(), True) for f in RAW_FIELDS])

# Shaped readings table.
READINGS_SCHEMA = StructType(
    [
        StructField("signal_date", DateType(), True),
        StructField("signal_ts", TimestampType(), True),
        StructField("create_date", DateType(), True),
        StructField("create_ts", TimestampType(), True),
        StructField("signals", MapType(StringType(), StringType(), True), True),
    ]
)

# Generic (id, value) message of the simple variant.
GENERIC_MESSAGE_SCHEMA = StructType(
    [StructField("id", StringType(), True), StructField("value", DoubleType(), True)]
)

# Venue record as extracted from free text.
VENUE_SCHEMA = StructType(
    [
        StructField("name", StringType(), True),
        StructField("location", StringType(), True),
        StructField("capacity", StringType(), True),
        StructField("priceRange", StringType(), True),
        StructField("rating", DoubleType(), True),
        StructField("description", StringType(), True),
        StructField("image", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("email", StringType(), True),
        StructField("amenities", ArrayType(StringType(), True), True),
        StructField("features", ArrayType(StringType(), True), True),
    ]
)
# As read from text: the rating as written (a JSON number or a quoted number),
# converted to double when the records are normalised.
VENUE_TEXT_SCHEMA = StructType(
    [StructField(f.name, StringType(), True) if f.name == "rating" else f for f in VENUE_SCHEMA.fields]
)
VENUE_TEXT_ARRAY_SCHEMA = ArrayType(VENUE_TEXT_SCHEMA, True)
