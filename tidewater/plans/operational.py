"""Bronze straight to gold: current rows of every captured table, rebuilt in full."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.operators.cdc import current_state
from tidewater.plans import schemas as SC
from tidewater.plans.marts import notifications_daily, stock_alerts

log = logging.getLogger(__name__)


def _current(bronze: DataFrame, schema: T.StructType, key: str, deletes: str) -> DataFrame:
    return current_state(bronze, "id", schema, deletes).withColumnRenamed("id", key)


def dim_users(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    return _current(bronze, SC.USER, "user_id", deletes)


def dim_products(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    return _current(bronze, SC.PRODUCT, "product_id", deletes)


def fact_orders(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    return _current(bronze, SC.ORDER, "order_id", deletes)


def fact_payments(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    return _current(bronze, SC.PAYMENT, "payment_id", deletes)


def notifications(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    return notifications_daily(_current(bronze, SC.NOTIFICATION, "notif_id", deletes))


def fact_stock_alerts(raw_events: DataFrame) -> DataFrame:
    return stock_alerts(raw_events, SC.STOCK_ALERT)


BUILDERS: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "dim_users": ("cdc/users", dim_users),
    "dim_products": ("cdc/products", dim_products),
    "fact_orders": ("cdc/orders", fact_orders),
    "fact_payments": ("cdc/payments", fact_payments),
    "fact_stock_alerts": ("events/stock_alert", fact_stock_alerts),
    "notifications_daily": ("cdc/notifications", notifications),
}


def build_gold(read: Callable[[str], DataFrame | None], write: Callable[[str, DataFrame], None]) -> dict[str, str]:
    """Build every table whose source exists; a failing table is reported and the others go on."""
    failures: dict[str, str] = {}
    for table, (source, build) in BUILDERS.items():
        try:
            bronze = read(source)
            if bronze is not None:
                write(table, build(bronze))
        except Exception as error:  # noqa: BLE001
            log.error("%s failed: %s", table, error)
            failures[table] = str(error)
    return failures
