import datetime
from decimal import Decimal

import pytest

from remitlens.schema import FACT_ORDERS, FACT_SETTLEMENTS
from remitlens.session import local_session, remove_written

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_written(session)
    session.stop()


def day(number: int) -> datetime.date:
    """Day ``number`` after a Monday."""
    return datetime.date(2026, 9, 7) + datetime.timedelta(days=number)


def _typed(schema, values: dict) -> tuple:
    row = []
    for field in schema.fields:
        value = values[field.name]
        row.append(Decimal(str(value)) if field.dataType.typeName() == "decimal" and value is not None else value)
    return tuple(row)


@pytest.fixture(scope="session")
def orders_of(spark):
    """Orders from dicts that name what differs from an order without any mismatch."""
    base = dict(
        courier_id=1, merchant_id="M-1", geo_id=1, order_date=day(0), delivery_date=None, order_status="DELIVERED",
        payment_mode="COD", cod_amount=1000, declared_weight=1, order_value=1000, promised_eta_hrs=72,
        actual_eta_hrs=70,
    )

    def make(*rows: dict):
        full = [_typed(FACT_ORDERS, {**base, "order_id": "O" + r["awb_number"], **r}) for r in rows]
        return spark.createDataFrame(full, FACT_ORDERS)

    return make


@pytest.fixture(scope="session")
def settlements_of(spark):
    base = dict(
        batch_id="B1", courier_id=1, settlement_date=day(5), settled_cod=1000, charged_weight=1, forward_charge=42,
        rto_charge=0, cod_fee=20,
    )

    def make(*rows: dict):
        full = [
            _typed(FACT_SETTLEMENTS, {**base, "settlement_id": f"S{i}", **r}) for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(full, FACT_SETTLEMENTS)

    return make
