"""A dimension row that comes twice changes no report."""

import pytest
from helpers import tables, utc

from parceltrail import checks
from parceltrail.checks import domain
from parceltrail.checks.marts import MARTS
from parceltrail.sources.tables import SCHEMAS, Tables

FACTS = {
    "order_order",
    "waybill_waybill",
    "dm_waybill_waybill",
    "waybill_waybill_line",
    "waybill_problem_piece",
    "waybill_return_bill",
    "smu_template_2",
}


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("once"))
    t = domain.tables(spark, sf_dir)
    for name in SCHEMAS:
        t[name].coalesce(1).write.parquet(f"{root}/{name}")
    return Tables.from_parquet(spark, root)


@pytest.mark.parametrize("name", sorted(MARTS))
def test_repeated_dimension_rows(stored, name):
    doubled = stored
    for table in SCHEMAS.keys() - FACTS:
        doubled = doubled.with_table(table, stored[table].unionByName(stored[table]))
    got, want = MARTS[name](doubled), MARTS[name](stored)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_newest_price_of_a_lane_is_a_query(spark, tmp_path, monkeypatch):
    """price_effective returns the rows of the dimension: the newest of a lane whose search code is still valid."""
    lane = {"shipping_client_id": 1, "sender_location_id": 2, "recipient_location_id": 3, "express_type": "0", "deleted": "0"}
    far, past = utc("2024-03-01"), utc("2024-01-30")
    rows = [
        lane | {"search_code": "old", "created_at": utc("2023-01-01"), "end_expire_time": far, "max_sla": 9},
        lane | {"search_code": "new", "created_at": utc("2023-02-01"), "end_expire_time": far, "max_sla": 4},
        lane | {"search_code": "over", "created_at": utc("2023-03-01"), "end_expire_time": past, "max_sla": 1},
        lane | {"shipping_client_id": None, "search_code": None, "created_at": utc("2023-02-01"), "end_expire_time": far},
    ]
    monkeypatch.setattr(domain, "tables", lambda *_: tables(spark, standard_shipping_fee=rows))
    got = checks.queries()["price_effective"](spark, str(tmp_path)).collect()
    assert sorted((r.shipping_client_id or 0, r.search_code, r.max_sla) for r in got) == [(0, None, None), (1, "new", 4)]
