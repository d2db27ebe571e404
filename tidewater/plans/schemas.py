"""Payload schemas of captured tables and typed events."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(15, 2),
    "timestamp": T.TimestampType(),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type [not null]`` entries, without needing a session."""
    out = []
    for entry in fields.split(","):
        name, kind, *rest = entry.split()
        out.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(out)


# Operational pipeline, images keyed by ``id``.
USER = _struct("id bigint, name string, email string, user_type string, created_at timestamp, updated_at timestamp")
PRODUCT = _struct(
    "id bigint, seller_id bigint, title string, description string, category string, price double, stock int, "
    "created_at timestamp, updated_at timestamp"
)
ORDER = _struct(
    "id bigint, buyer_id bigint, product_id bigint, quantity int, unit_price double, total_amount double, "
    "status string, created_at timestamp, updated_at timestamp"
)
PAYMENT = _struct(
    "id bigint, order_id bigint, amount double, method string, status string, created_at timestamp, processed_at timestamp"
)
NOTIFICATION = _struct(
    "id bigint, user_id bigint, channel string, event_type string, subject string, body string, created_at timestamp"
)
STOCK_ALERT = _struct("product_id bigint, seller_id bigint, title string, stock int, threshold int")

# Historised pipeline, text keys.
SILVER_USER = _struct(
    "user_id string, email string, name string, phone string, document_type string, document_number string, "
    "birth_date string, gender string, status string, created_at timestamp, updated_at timestamp"
)
SILVER_PRODUCT = _struct(
    "product_id string, title string, description string, category_id string, brand string, sku string, "
    "price money, stock_quantity int, status string, created_at timestamp, updated_at timestamp"
)
SILVER_ORDER = _struct(
    "order_id string, user_id string, status string, total_amount money, currency string, "
    "payment_method string, shipping_address_id string, created_at timestamp, updated_at timestamp, "
    "completed_at timestamp, items_count int"
)
USER_TRACKED = ("email", "name", "phone", "document_number", "status")
PRODUCT_TRACKED = ("title", "price", "stock_quantity", "status", "category_id")

# Typed behaviour events; fields marked NOT NULL are mandatory.
CLICK = _struct(
    "event_id string not null, user_id string, session_id string, product_id string, page_type string, "
    "position bigint, ts timestamp not null"
)
CART = _struct(
    "event_id string not null, user_id string, session_id string, product_id string, quantity bigint, "
    "unit_price double, action string, ts timestamp not null"
)
SEARCH = _struct(
    "event_id string not null, user_id string, session_id string, query string, results_count bigint, "
    "category_filter string, ts timestamp not null"
)
PURCHASE = _struct(
    "event_id string not null, user_id string not null, session_id string, order_id string not null, "
    "total_amount double not null, items_count bigint, payment_method string, ts timestamp not null"
)
EVENT_SCHEMAS = {"events.clicks": CLICK, "events.cart": CART, "events.search": SEARCH, "events.purchase": PURCHASE}
