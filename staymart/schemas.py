"""Schemas of the raw records, the canonical rows and the logs."""

from pyspark.sql import types as T

TEXT, DATE, DOUBLE, LONG = T.StringType(), T.DateType(), T.DoubleType(), T.LongType()
AMOUNT = T.DecimalType(18, 2)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Only the leaves that are read. The JSON source cannot prune below the top
# level, so leaving the other leaves out of the schema is the pruning. The amount
# is text, as a number written as text would else be read as NULL.
RAW_RECORD = struct(
    updated=TEXT,
    label=TEXT,
    status=TEXT,
    start=TEXT,
    end=TEXT,
    accommodations=struct(reservation=TEXT),
    accommodation_details=struct(accommodation=TEXT),
    currencies=struct(booker=TEXT),
    commission=struct(estimate_commission_amount=struct(booker_currency=TEXT)),
    booker=struct(travel_purpose=TEXT, address=struct(country=TEXT)),
)

CANONICAL = struct(
    transaction_id=TEXT,
    conversion_key=TEXT,
    property_id=TEXT,
    status=TEXT,
    currency=TEXT,
    check_in_date=DATE,
    check_out_date=DATE,
    revenue=AMOUNT,
    travel_purpose=TEXT,
    country_code=TEXT,
    site_key=TEXT,
    referral_property_id=TEXT,
    device=TEXT,
    region=TEXT,
    revenue_usd=AMOUNT,
)

KEY = "transaction_id"

LOOKUP = struct(key=TEXT, value=TEXT)
RATES = struct(currency=TEXT, rate_to_usd=DOUBLE)

COMMIT = struct(snapshot_id=LONG, committed_at=T.TimestampType(), operation=TEXT, path=TEXT)
TRACKING = struct(snapshot_id=LONG, processed_at=T.TimestampType())
EXPIRED = struct(snapshot_id=LONG)
MANIFEST = struct(file=TEXT, bytes=LONG, rows=LONG)
