"""Record, envelope, document and target schemas, and the fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

INT, LONG, TEXT, DOUBLE, FLAG, TIME = (
    T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampType()
)
MONEY = T.DecimalType(10, 2)


def row_type(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CUSTOMER_ROW = row_type(
    customer_id=INT, email=TEXT, full_name=TEXT, phone=TEXT, created_at=LONG, updated_at=LONG
)
ORDER_ROW = row_type(
    order_id=INT, customer_id=INT, total_amount=MONEY, status=TEXT, payment_method=TEXT, created_at=LONG, updated_at=LONG
)
ORDER_ITEM_ROW = row_type(
    item_id=INT, order_id=INT, product_name=TEXT, quantity=INT, price=MONEY, created_at=LONG
)
EVENT_DOCUMENT = row_type(
    _id=TEXT, event_id=TEXT, customer_id=INT, event_type=TEXT, timestamp=TEXT,
    metadata=row_type(page=TEXT, device=TEXT, session_id=TEXT, ip_address=TEXT, updated_at=TEXT, processed=FLAG),
)
INVENTORY_DOCUMENT = row_type(
    _id=TEXT, product_id=TEXT, warehouse=TEXT, quantity=INT, reorder_point=INT, unit_cost=DOUBLE,
    last_updated=TEXT, status=TEXT,
)

RELATIONAL_SOURCE = row_type(
    version=TEXT, connector=TEXT, name=TEXT, ts_ms=LONG, db=TEXT, schema=TEXT, table=TEXT, lsn=LONG
)
DOCUMENT_SOURCE = row_type(connector=TEXT, name=TEXT, db=TEXT, collection=TEXT)


def relational_envelope(row: T.StructType) -> T.StructType:
    """Envelope of a relational change whose images have the given row type."""
    return row_type(payload=row_type(op=TEXT, ts_ms=LONG, source=RELATIONAL_SOURCE, before=row, after=row))


DOCUMENT_ENVELOPE = row_type(payload=row_type(op=TEXT, ts_ms=LONG, source=DOCUMENT_SOURCE, after=TEXT))

TRACKING = row_type(
    source_table=TEXT, target_table=TEXT, kafka_topic=TEXT, total_records_migrated=LONG,
    last_migrated_at=TIME, migration_status=TEXT, last_kafka_offset=LONG,
)

# Operation codes, status sets and event types of the two sides.
SNAPSHOT, INSERT, UPDATE, DELETE = "r", "c", "u", "d"
OPERATIONS = ("r", "c", "u", "d")
UPSERTS = ("r", "c", "u")
SOURCE_ORDER_STATUS = ("pending", "confirmed", "shipped", "delivered", "cancelled")
TARGET_ORDER_STATUS = ("pending", "processing", "completed", "cancelled", "refunded")
STATUS_TRANSITIONS = (
    ("pending", "confirmed"),
    ("pending", "cancelled"),
    ("confirmed", "shipped"),
    ("confirmed", "cancelled"),
    ("shipped", "delivered"),
)
TARGET_EVENT_TYPES = ("login", "logout", "purchase", "view", "cart_add", "cart_remove")
EVENT_TYPE_MAP = {"page_view": "view", "add_to_cart": "cart_add", "remove_from_cart": "cart_remove"}
EMAIL_PATTERN = r"(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
RELATIONAL_SYSTEM = "postgres_local"
DOCUMENT_SYSTEM = "mongodb_atlas"
