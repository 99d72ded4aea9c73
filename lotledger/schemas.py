"""Table contracts."""

from pyspark.sql import types as T

CAPTURE_SCHEMA = T.StructType([
    T.StructField("capture_id", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("dealer_url", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("page_ord", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("error", T.StringType()),  # null | dns | timeout | other
    T.StructField("attempt", T.IntegerType()),  # 1 plain, 2 browser, 3 unlocked, 4 remote browser
    T.StructField("cname", T.StringType()),
    T.StructField("captured_at", T.TimestampType()),
])

# The normalised vehicle: 23 columns.
VEHICLE_TYPES = {
    "vin": "string", "stock_number": "string", "make": "string", "model": "string",
    "trim": "string", "year": "int", "mileage": "int", "price": "double",
    "msrp": "double", "exterior_color": "string", "interior_color": "string",
    "transmission": "string", "drivetrain": "string", "fuel_type": "string",
    "engine": "string", "body_style": "string", "doors": "int", "condition": "string",
    "location": "string", "url": "string", "image_url": "string",
    "description": "string", "raw_json": "string",
}
VEHICLE_COLUMNS = list(VEHICLE_TYPES)

MESSAGE_SCHEMA = T.StructType([
    T.StructField("runId", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("totalUrls", T.IntegerType()),
])
