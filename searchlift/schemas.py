"""Table schemas, column types and domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# Positions and landed CTRs keep what is landed; rounding is for display and for means.
POSITION = T.DecimalType(15, 9)
POSITION_PLACES = 9
WATCH_POSITION = T.DecimalType(6, 2)
CTR = T.DecimalType(12, 6)
LANDED_CTR = T.DecimalType(14, 12)
RATE = T.DecimalType(24, 12)
TICKET = T.DecimalType(24, 6)
SCORE = T.DecimalType(8, 2)

# The four kinds of work a keyword may need.
NONE = "NONE"
CONTENT = "CONTENT"
LINK_BUILDING = "LINK_BUILDING"
BOTH = "BOTH"
FACTORS = (NONE, CONTENT, LINK_BUILDING, BOTH)

# Fixed value: the deepest position the curve knows.
LAST_POSITION = 20

# Fixed value: the text that ends the host part of a page URL on the site.
HOST_MARKER = ".cl/"

# One row of a search-console response, with an optional landing batch and row number in the file.
SEARCH_ROW = T.StructType(
    [
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("clicks", T.LongType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("ctr", T.DoubleType()),
        T.StructField("position", T.DoubleType()),
        T.StructField("ord", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)

FACTS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("ctr", LANDED_CTR),
        T.StructField("position", POSITION),
        T.StructField("date", T.DateType()),
    ]
)
FACT_KEYS = ("date", "query", "page")

GAPS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("avg_position", POSITION),
        T.StructField("ctr_actual", LANDED_CTR),
        T.StructField("is_branded", T.BooleanType()),
        T.StructField("ctr_expected", CTR),
        T.StructField("ctr_gap", LANDED_CTR),
        T.StructField("agency_factor", T.StringType()),
        T.StructField("pos_target", POSITION),
        T.StructField("ctr_target", CTR),
        T.StructField("ctr_target_adjusted", T.DecimalType(19, 9)),
        T.StructField("delta_clicks", T.LongType()),
        T.StructField("conversion_rate", RATE),
        T.StructField("avg_ticket", T.LongType()),
        T.StructField("revenue_final", T.LongType()),
        T.StructField("raw_score", T.DecimalType(29, 4)),
        T.StructField("opportunity_score", SCORE),
        T.StructField("date", T.DateType()),
    ]
)
# The staged form, before a date's scores are scaled.
RAW_GAPS = T.StructType([f for f in GAPS.fields if f.name != "opportunity_score"])
GAP_KEYS = ("date", "query", "page_url")

CTR_CURVE = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("ctr_low", CTR),
        T.StructField("ctr_mid", CTR),
        T.StructField("ctr_high", CTR),
        T.StructField("color_zone", T.StringType()),
    ]
)

FACTOR_PARAMS = T.StructType(
    [
        T.StructField("factor_name", T.StringType()),
        T.StructField("ctr_boost", T.DecimalType(6, 3)),
        T.StructField("success_prob", T.DecimalType(6, 3)),
        T.StructField("pos_delta", T.DecimalType(6, 2)),
        T.StructField("impact_weeks_min", T.IntegerType()),
        T.StructField("impact_weeks_max", T.IntegerType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("page_url", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("is_blando", T.BooleanType()),
        T.StructField("conversion_rate", RATE),
        T.StructField("avg_ticket", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

WATCHLIST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("baseline_position", WATCH_POSITION),
        T.StructField("baseline_date", T.DateType()),
        T.StructField("target_position", WATCH_POSITION),
        T.StructField("agency_factor_aplicado", T.StringType()),
        T.StructField("notas", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
WATCH_KEYS = ("query", "page_url")
