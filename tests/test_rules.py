from decimal import Decimal

import pytest

from remitlens.operators.reconcile import outcomes, reconcile
from tests.conftest import day

# Order values, settlement values, expected (type, expected, actual, variance, severity) list.
CASES = {
    "within two percent": (dict(cod_amount=400), dict(settled_cod=392), []),
    "beyond two percent": (
        dict(cod_amount=400), dict(settled_cod="391.99"), [("COD_SHORT_REMITTANCE", 400, "391.99", "8.01", "LOW")]
    ),
    "at the cap": (dict(cod_amount=5000), dict(settled_cod=4990), []),
    "beyond the cap": (
        dict(cod_amount=5000), dict(settled_cod="4989.99"),
        [("COD_SHORT_REMITTANCE", 5000, "4989.99", "10.01", "LOW")],
    ),
    "no cash to collect": (dict(cod_amount=0), dict(settled_cod=-5), []),
    "short by exactly 100": (
        dict(cod_amount=5000), dict(settled_cod=4900), [("COD_SHORT_REMITTANCE", 5000, 4900, 100, "LOW")]
    ),
    "short by exactly 500": (
        dict(cod_amount=5000), dict(settled_cod=4500), [("COD_SHORT_REMITTANCE", 5000, 4500, 500, "MEDIUM")]
    ),
    "short by more than 500": (
        dict(cod_amount=5000), dict(settled_cod="4499.99"),
        [("COD_SHORT_REMITTANCE", 5000, "4499.99", "500.01", "HIGH")],
    ),
    "ten percent heavier": ({}, dict(charged_weight="1.100"), []),
    "more than ten percent heavier": (
        {}, dict(charged_weight="1.101"), [("WEIGHT_DISPUTE", 1, "1.10", 6, "LOW")]
    ),
    "weight money graded before rounding": (
        dict(declared_weight=1), dict(charged_weight="2.670"), [("WEIGHT_DISPUTE", 1, "2.67", 100, "MEDIUM")]
    ),
    "return charged on a return": (dict(order_status="RTO", actual_eta_hrs=None), dict(rto_charge=150), []),
    "return charged on a delivery": ({}, dict(rto_charge=150), [("PHANTOM_RTO_CHARGE", 0, 150, 150, "MEDIUM")]),
    "14 days": ({}, dict(settlement_date=day(14)), []),
    "15 days": ({}, dict(settlement_date=day(15)), [("OVERDUE_REMITTANCE", 14, 15, 1000, "MEDIUM")]),
    "28 days": ({}, dict(settlement_date=day(28)), [("OVERDUE_REMITTANCE", 14, 28, 1000, "MEDIUM")]),
    "29 days": ({}, dict(settlement_date=day(29)), [("OVERDUE_REMITTANCE", 14, 29, 1000, "HIGH")]),
    "prepaid and late": (
        dict(payment_mode="Prepaid", cod_amount=0), dict(settled_cod=0, settlement_date=day(19)),
        [("OVERDUE_REMITTANCE", 14, 19, 0, "MEDIUM")],
    ),
    "eta at the limit": (dict(actual_eta_hrs="93.60"), {}, []),
    "eta beyond the limit": (dict(actual_eta_hrs="93.61"), {}, [("ETA_SLA_BREACH", 72, "93.61", 0, "LOW")]),
    "eta unknown": (dict(actual_eta_hrs=None), {}, []),
    "late but not delivered": (dict(order_status="LOST", actual_eta_hrs=200), {}, []),
    "forward at the limit": (dict(declared_weight=2), dict(charged_weight=2, forward_charge="74.75"), []),
    "forward beyond the limit": (
        dict(declared_weight=2), dict(charged_weight=2, forward_charge="74.76"),
        [("EXCESS_FORWARD_CHARGE", 65, "74.76", "9.76", "LOW")],
    ),
    "light slab ends at one": (
        dict(declared_weight=1), dict(forward_charge=50), [("EXCESS_FORWARD_CHARGE", 42, 50, 8, "LOW")]
    ),
    "middle slab starts above one": (
        dict(declared_weight="1.001"), dict(charged_weight="1.001", forward_charge=74), []
    ),
    "middle slab ends at three": (
        dict(declared_weight=3), dict(charged_weight=3, forward_charge=75),
        [("EXCESS_FORWARD_CHARGE", 65, 75, 10, "LOW")],
    ),
    "heavy slab": (dict(declared_weight="3.001"), dict(charged_weight="3.001", forward_charge=109), []),
    "three at once": (
        dict(cod_amount=5000, declared_weight=2),
        dict(settled_cod=4600, charged_weight="2.5", rto_charge=150, forward_charge=65),
        [
            ("COD_SHORT_REMITTANCE", 5000, 4600, 400, "MEDIUM"),
            ("PHANTOM_RTO_CHARGE", 0, 150, 150, "MEDIUM"),
            ("WEIGHT_DISPUTE", 2, "2.5", 30, "LOW"),
        ],
    ),
}


@pytest.fixture(scope="module")
def found(orders_of, settlements_of):
    """All cases in one run, keyed by AWB."""
    orders = orders_of(*[{"awb_number": f"A{i}", **case[0]} for i, case in enumerate(CASES.values())])
    settled = settlements_of(*[{"awb_number": f"A{i}", **case[1]} for i, case in enumerate(CASES.values())])
    rows = {}
    for r in reconcile(settled, orders).collect():
        rows.setdefault(r.awb_number, []).append(
            (r.discrepancy_type, r.expected_value, r.actual_value, r.variance_rs, r.severity)
        )
        assert r.discrepancy_id == f"{r.awb_number}|B1|{r.discrepancy_type}"
    # The stored form must say the same.
    for r in outcomes(settled, orders).collect():
        listed = sorted(tuple(d) for d in r.disputes)
        assert listed == sorted(rows.get(r.awb_number, []))
        assert r.dispute_count == len(listed)
        assert r.leakage_rs == sum(d[3] for d in listed)
    return rows


@pytest.mark.parametrize("name", CASES)
def test_rule(found, name):
    expected = [
        (kind, *(Decimal(str(v)).quantize(Decimal("0.01")) for v in values), grade)
        for kind, *values, grade in CASES[name][2]
    ]
    assert sorted(found.get(f"A{list(CASES).index(name)}", [])) == sorted(expected)


def test_published_sample_events(orders_of, settlements_of):
    """Shapes of published events: slab 95 charged 114, a phantom return of 140, a prepaid order after 19 days."""
    orders = orders_of(
        dict(awb_number="AWB100000", declared_weight="7.324"),
        dict(awb_number="AWB100001", declared_weight="7.099"),
        dict(awb_number="AWB100008", payment_mode="Prepaid", cod_amount=0),
    )
    settled = settlements_of(
        dict(awb_number="AWB100000", batch_id="BATCH-D", charged_weight="7.324", forward_charge=114),
        dict(awb_number="AWB100001", batch_id="BATCH-A", charged_weight="7.099", forward_charge=95, rto_charge=140),
        dict(awb_number="AWB100008", batch_id="BATCH-D", settled_cod=0, settlement_date=day(19)),
    )
    rows = {r.discrepancy_id: (r.expected_value, r.actual_value, r.variance_rs, r.severity)
            for r in reconcile(settled, orders).collect()}
    assert rows == {
        "AWB100000|BATCH-D|EXCESS_FORWARD_CHARGE": (95, 114, 19, "LOW"),
        "AWB100001|BATCH-A|PHANTOM_RTO_CHARGE": (0, 140, 140, "MEDIUM"),
        "AWB100008|BATCH-D|OVERDUE_REMITTANCE": (14, 19, 0, "MEDIUM"),
    }
