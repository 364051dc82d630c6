"""Table schemas of the warehouse and of the marketplace data set."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _DATE, _TIME = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()


def _money(precision: int = 12) -> T.DecimalType:
    return T.DecimalType(precision, 2)


_WEIGHT = T.DecimalType(8, 3)


def _table(*fields: tuple) -> T.StructType:
    """Fields are (name, type) or (name, type, nullable); not nullable unless said."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else False) for f in fields])


DIM_COURIER = _table(
    ("courier_id", _INT), ("courier_name", _TEXT), ("base_rate_rs", _money(10)), ("sla_hours", _INT)
)
DIM_GEOGRAPHY = _table(("geo_id", _INT), ("city", _TEXT), ("tier", _TEXT), ("zone", _TEXT))
DIM_MERCHANT = _table(("merchant_id", _TEXT), ("merchant_name", _TEXT), ("category", _TEXT))
DIM_DATE = _table(("date_id", _DATE), ("week_id", _TEXT), ("month_id", _TEXT), ("is_festival", T.BooleanType()))
FACT_ORDERS = _table(
    ("order_id", _TEXT),
    ("awb_number", _TEXT),
    ("courier_id", _INT),
    ("merchant_id", _TEXT),
    ("geo_id", _INT),
    ("order_date", _DATE),
    ("delivery_date", _DATE, True),
    ("order_status", _TEXT),
    ("payment_mode", _TEXT),
    ("cod_amount", _money()),
    ("declared_weight", _WEIGHT),
    ("order_value", _money()),
    ("promised_eta_hrs", _INT),
    ("actual_eta_hrs", T.DecimalType(8, 2), True),
)
FACT_SETTLEMENTS = _table(
    ("settlement_id", _TEXT),
    ("awb_number", _TEXT),
    ("batch_id", _TEXT),
    ("courier_id", _INT),
    ("settlement_date", _DATE),
    ("settled_cod", _money()),
    ("charged_weight", _WEIGHT),
    ("forward_charge", _money(10)),
    ("rto_charge", _money(10)),
    ("cod_fee", _money(10)),
)
FACT_DISCREPANCIES = _table(
    ("discrepancy_id", _TEXT),
    ("awb_number", _TEXT),
    ("batch_id", _TEXT),
    ("courier_id", _INT),
    ("merchant_id", _TEXT),
    ("geo_id", _INT),
    ("discrepancy_type", _TEXT),
    ("expected_value", _money(), True),
    ("actual_value", _money(), True),
    ("variance_rs", _money()),
    ("severity", _TEXT),
)
# Counts and sums of a whole day's cell, so wider than those of one row.
DAILY_KPIS = _table(
    ("kpi_date", _DATE),
    ("courier_id", _INT),
    ("geo_id", _INT),
    ("orders", T.LongType()),
    ("disputed_awbs", T.LongType()),
    ("leakage_rs", _money(24)),
    ("avg_dso_days", T.DecimalType(8, 2), True),
)

MARKET_ORDERS = _table(
    ("order_id", _TEXT),
    ("customer_id", _TEXT),
    ("order_status", _TEXT),
    ("order_purchase_timestamp", _TIME, True),
    ("order_approved_at", _TIME, True),
    ("order_delivered_carrier_date", _TIME, True),
    ("order_delivered_customer_date", _TIME, True),
    ("order_estimated_delivery_date", _TIME, True),
)
MARKET_ITEMS = _table(
    ("order_id", _TEXT),
    ("order_item_id", _INT),
    ("product_id", _TEXT),
    ("seller_id", _TEXT),
    ("shipping_limit_date", _TIME, True),
    ("price", _money()),
    ("freight_value", _money()),
)
MARKET_PAYMENTS = _table(
    ("order_id", _TEXT),
    ("payment_sequential", _INT),
    ("payment_type", _TEXT),
    ("payment_installments", _INT),
    ("payment_value", _money()),
)
MARKET_REVIEWS = _table(
    ("review_id", _TEXT),
    ("order_id", _TEXT),
    ("review_score", _INT),
    ("review_comment_title", _TEXT, True),
    ("review_comment_message", _TEXT, True),
    ("review_creation_date", _TIME, True),
    ("review_answer_timestamp", _TIME, True),
)

WAREHOUSE_TABLES = {
    "dim_courier": DIM_COURIER,
    "dim_geography": DIM_GEOGRAPHY,
    "dim_merchant": DIM_MERCHANT,
    "fact_orders": FACT_ORDERS,
    "fact_settlements": FACT_SETTLEMENTS,
}
MARKET_TABLES = {
    "orders": MARKET_ORDERS,
    "items": MARKET_ITEMS,
    "payments": MARKET_PAYMENTS,
    "reviews": MARKET_REVIEWS,
}

DISPUTES = T.ArrayType(
    T.StructType(
        [
            T.StructField("discrepancy_type", _TEXT),
            T.StructField("expected_value", _money()),
            T.StructField("actual_value", _money()),
            T.StructField("variance_rs", _money()),
            T.StructField("severity", _TEXT),
        ]
    )
)
