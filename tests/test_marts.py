"""Handmade rows per report: versions, missing sides, boundary times and the oddities each report keeps."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import by_key, options, tables, utc
from parceltrail import plans
from parceltrail.functions.clock import Clock

NOW = Clock.at("2024-01-31T03:00:00Z")
OPTIONS = options(
    orderSource={"0": "Shopee platform", "1": "Tokopedia", "2": "Blibli", "3": "VIP Customer Portal"},
    waybillSource={"0": "Shopee platform", "2": "Blibli", "3": "VIP Customer Portal"},
    orderStatus={"0": "Cancel Order", "1": "Picked Up", "2": "Pending"},
    serviceType={"0": "Pick up"},
    expressType={"0": "STD"},
    waybillStatus={"1": "Signed", "2": "Return Received", "3": "Delivering"},
    returnFlag={"0": "Tidak Retur", "1": "Retur"},
    voidFlag={"0": "Not void", "1": "Void"},
    returnConfirmStatus={"1": "Confirmed"},
    operationType={"03": "Pickup Failure", "09": "Delivery", "18": "Problem", "30": "Confirm Return Bill"},
    problemType={"01": "Delivery problem", "02": "Ignored"},
    branchLevel={"0": "TH", "2": "MH"},
)


@pytest.fixture(autouse=True)
def interpreted(spark):
    """A few rows do not repay compiling each plan."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


def waybill(number, **more):
    row = {
        "waybill_no": number,
        "shipping_time": utc("2024-01-20 02:00:00"),
        "update_time": utc("2024-01-25 02:00:00"),
        "void_flag": "0",
        "deleted": "0",
        "return_flag": "0",
        "waybill_status": "3",
    }
    return {**row, **more}


def order(number, **more):
    row = {
        "waybill_no": number,
        "input_time": utc("2024-01-20 01:00:00"),
        "update_time": utc("2024-01-20 01:00:00"),
        "order_source": "3",
        "order_status": "1",
    }
    return {**row, **more}


def scan(number, at, **more):
    return {"waybill_no": number, "record_time": utc(at), "operation_branch_name": "TH A", **more}


@pytest.mark.parametrize(
    ("registered", "confirmed", "state", "category"),
    [
        ("2024-01-29 18:00:00", None, "Backlog Confirm Return", "<3 Days"),
        ("2024-01-28 16:00:00", None, "Backlog Confirm Return", "3-7 Days"),
        ("2024-01-24 02:00:00", None, "Backlog Confirm Return", "3-7 Days"),
        ("2024-01-23 02:00:00", None, "Backlog Confirm Return", "8-14 Days"),
        ("2024-01-17 02:00:00", None, "Backlog Confirm Return", "8-14 Days"),
        ("2024-01-16 02:00:00", None, "Backlog Confirm Return", "15-30 Days"),
        ("2024-01-01 02:00:00", None, "Backlog Confirm Return", "15-30 Days"),
        ("2023-12-31 02:00:00", None, "Backlog Confirm Return", ">30 Days"),
        ("2024-02-01 02:00:00", None, "Backlog Confirm Return", "<3 Days"),
        ("2023-12-31 02:00:00", "2024-01-20 02:00:00", "Backlog Return", "8-14 Days"),
    ],
)
def test_return_backlog_states_and_buckets(spark, registered, confirmed, state, category):
    bill = {
        "waybill_no": "A",
        "update_time": utc("2024-01-25 00:00:00"),
        "return_record_time": utc(registered),
        "return_confirm_record_time": utc(confirmed) if confirmed else None,
    }
    t = tables(spark, system_option=OPTIONS, waybill_waybill=[waybill("A")], waybill_return_bill=[bill])
    row = plans.return_backlog(t, NOW).collect()[0]
    assert row["backlog_return_flag"] == state
    column = "backlog_confirm_category" if state.startswith("Backlog Confirm") else "backlog_return_category"
    assert row[column] == category


def test_return_backlog_takes_newest_versions_and_drops_delivered_returns(spark):
    def bill(number, updated, **more):
        row = {"waybill_no": number, "update_time": utc(updated), "return_record_time": utc("2024-01-20 02:00:00")}
        return {**row, **more}

    t = tables(
        spark,
        system_option=OPTIONS,
        waybill_waybill=[
            waybill("A", sender_name="old", update_time=utc("2024-01-21 00:00:00")),
            waybill("A", sender_name="new"),
            waybill("B"),
            waybill("C", void_flag="1"),
        ],
        waybill_return_bill=[
            bill("A", "2024-01-22 00:00:00", return_pod_record_time=utc("2024-01-22 00:00:00")),
            bill("A", "2024-01-23 00:00:00", return_type_id=1),
            bill("B", "2024-01-23 00:00:00", return_pod_record_time=utc("2024-01-22 00:00:00")),
            bill("C", "2024-01-23 00:00:00"),
        ],
        return_type=[{"id": 1, "return_type": "Refused", "deleted": 1}],
    )
    rows = by_key(plans.return_backlog(t, NOW))
    assert set(rows) == {"A"}
    assert rows["A"]["sender_name"] == "new"
    assert rows["A"]["remarks_return"] is None
    assert rows["A"]["shipping_time"] == datetime(2024, 1, 20, 9)


def dwell_tables(spark, scans, bills=()):
    rows = [waybill("A", shipping_time=utc("2023-11-05 00:00:00"), update_time=utc("2023-11-06 00:00:00"))]
    return tables(
        spark, system_option=OPTIONS, waybill_waybill=rows, waybill_waybill_line=scans, waybill_return_bill=list(bills)
    )


def test_dwell_needs_313_crossed_hours(spark):
    first = "2023-12-01 00:59:00"
    enough = dwell_tables(spark, [scan("A", at, operation_type="09") for at in (first, "2023-12-14 01:01:00")])
    row = plans.longest_dwell(enough, NOW).collect()[0]
    assert (row["scan_record_duration_hour"], row["rounded_duration_day"]) == (313, 14.0)
    short = dwell_tables(spark, [scan("A", at, operation_type="09") for at in (first, "2023-12-14 00:59:59")])
    assert plans.longest_dwell(short, NOW).count() == 0


def test_dwell_path_last_place_and_excluded_scans(spark):
    scans = [
        scan("A", "2023-12-01 00:00:00", operation_branch_name="X", operation_type="09"),
        scan("A", "2023-12-01 01:00:00", operation_branch_name="Y", operation_type="03"),
        scan("A", "2023-12-01 02:00:00", operation_branch_name="Y", operation_type="09"),
        scan("A", "2023-12-20 00:00:00", operation_branch_name="Y", operation_type="18"),
        scan("A", "2023-12-21 00:00:00", operation_branch_name="Y", operation_type="30"),
        scan("A", "2023-12-22 00:00:00", operation_branch_name="P", operation_type="18"),
        scan("A", "2023-12-22 00:00:00", operation_branch_name="Q", operation_type="18"),
    ]
    row = plans.longest_dwell(dwell_tables(spark, scans), NOW).collect()[0]
    assert row["branch_name_1"] == "Y"
    assert row["first_scan_time_branch"] == datetime(2023, 12, 1, 9)
    assert row["last_scan_time_branch"] == datetime(2023, 12, 20, 7)
    assert (row["previous_branch_name_1"], row["previous_branch_name_2"], row["next_branch_name"]) == ("Y", "X", "Y")
    assert row["last_location"] == "Q"
    assert (row["return_or_not"], row["return_or_not_last_scan"]) == ("Non-Return", "forward delivery")


def test_dwell_splits_at_the_confirmation(spark):
    bill = {
        "waybill_no": "A",
        "update_time": utc("2023-12-20 00:00:00"),
        "return_confirm_record_time": utc("2023-12-20 00:00:00"),
    }
    scans = [
        scan("A", at, operation_type="09")
        for at in ("2023-12-01 00:00:00", "2023-12-18 00:00:00", "2023-12-20 00:00:00", "2023-12-21 00:00:00", "2024-01-10 00:00:00")
    ]
    t = dwell_tables(spark, scans, [bill])
    assert plans.longest_dwell(t, NOW, returned=False).count() == 0
    rows = plans.longest_dwell(t, NOW, returned=True).orderBy("ranking").collect()
    assert [r["return_or_not_last_scan"] for r in rows] == ["return process", "forward delivery"]
    assert rows[0]["first_scan_time_branch"] == datetime(2023, 12, 21, 7)
    assert rows[1]["last_scan_time_branch"] == datetime(2023, 12, 18, 7)


def test_dwell_union_keeps_the_band(spark):
    scans = [scan("A", "2023-12-01 00:59:00", operation_type="09"), scan("A", "2023-12-20 01:01:00", operation_type="18")]
    inside = plans.longest_dwell(dwell_tables(spark, scans), NOW)
    rows = plans.longest_dwell_union(inside, inside, NOW).collect()
    assert len(rows) == 2 and rows[0]["operation_type_1_2"] == "Delivery - Problem"
    later = Clock.at("2024-02-10T03:00:00Z")
    assert plans.longest_dwell_union(inside, inside, later).count() == 0


def report(spark, **rows):
    t = tables(spark, system_option=OPTIONS, **rows)
    return by_key(plans.daily_report(t, NOW))


def test_daily_report_merges_sides(spark):
    rows = report(
        spark,
        order_order=[
            order("BOTH", pickup_time=utc("2024-01-21 00:00:00"), vip_customer_name="order shop", item_name="ordered"),
            order("OPEN", vip_customer_name="order shop", item_name="ordered", sender_name="from order"),
            order(None, order_no="older", input_time=utc("2024-01-19 00:00:00")),
            order(None, order_no="newer"),
        ],
        waybill_waybill=[
            waybill("BOTH", vip_customer_name="waybill shop", item_name="shipped", waybill_status="1"),
            waybill("OPEN", vip_customer_name="waybill shop", item_name="shipped", sender_name="from waybill"),
            waybill("ONLY", vip_customer_name="waybill shop", item_name="shipped", void_flag="1"),
        ],
    )
    assert set(rows) == {"BOTH", "OPEN", "ONLY", None}
    assert rows[None]["order_no"] == "newer"
    assert [rows[k]["sub_akun"] for k in ("BOTH", "OPEN", "ONLY")] == ["waybill shop", "order shop", None]
    assert [rows[k]["item_name"] for k in ("BOTH", "OPEN", "ONLY")] == ["shipped", "ordered", None]
    assert rows["OPEN"]["nama_pengirim"] == "from order"
    assert [rows[k]["last_status"] for k in ("BOTH", "OPEN", "ONLY", None)] == [
        "Delivered",
        "Delivery Process",
        "Cancel Order",
        "Cancel Order",
    ]


def test_daily_report_open_slot_labels_are_inverted_by_default(spark):
    orders = [
        order("AHEAD", service_type="0", end_pickup_time=utc("2024-02-02 00:00:00")),
        order("PAST", service_type="0", end_pickup_time=utc("2024-01-25 00:00:00")),
    ]
    t = tables(spark, system_option=OPTIONS, order_order=orders)
    rows = by_key(plans.daily_report(t, NOW))
    assert (rows["AHEAD"]["sla_pickup_status"], rows["PAST"]["sla_pickup_status"]) == ("Late", "Not Pick up Yet")
    sane = by_key(plans.daily_report(t, NOW, sane_pickup_sla=True))
    assert (sane["AHEAD"]["sla_pickup_status"], sane["PAST"]["sla_pickup_status"]) == ("Not Pick up Yet", "Late")


def test_daily_report_scans_and_problems(spark):
    def problem(at, reason, kind="01", number="A"):
        return {"waybill_no": number, "operation_time": utc(at), "problem_reason": reason, "problem_type": kind}

    rows = report(
        spark,
        waybill_waybill=[waybill("A", cod_amount=Decimal(0)), waybill("B")],
        waybill_waybill_line=[
            scan("A", "2024-01-21 00:00:00", operation_type="09"),
            scan("A", "2024-01-22 00:00:00", operation_type="09"),
            scan("A", "2024-01-23 00:00:00", operation_type="18", problem_type="01", problem_code="P1", photo_url="1"),
            scan("A", "2024-01-24 00:00:00", operation_type="18", problem_type="02", problem_code="P1", photo_url="2"),
            scan("B", "2024-01-23 00:00:00", operation_type="18", problem_type="01", problem_code="gone", photo_url="3"),
        ],
        waybill_problem_piece=[
            problem("2024-01-23 00:00:00", "Paket crosslabel"),
            problem("2024-01-23 00:00:00", None),
            problem("2024-01-25 00:00:00", "Paket Rusak"),
            problem("2024-01-26 00:00:00", "Package is lost", "02"),
        ],
        res_problem_package=[{"code": "P1", "register_reason_bahasa": "x", "deleted": "0"}],
    )
    a, b = rows["A"], rows["B"]
    assert (a["count_deliv_attempt"], a["count_pos"], b["count_deliv_attempt"], b["count_pos"]) == (2, 2, 0, 0)
    assert (a["first_pos_reason"], a["last_pos_reason"], a["last_pos_category"]) == ("Paket crosslabel", "Paket Rusak", "Lost")
    assert (a["first_pos_photo_url"], a["last_pos_photo_url"], b["first_pos_photo_url"]) == ("1", "1", None)
    assert (a["cod_type"], b["cod_type"]) == ("Non COD", "Non COD")
    assert a["last_scan_time"] == datetime(2024, 1, 24, 7)


@pytest.mark.parametrize(("sla", "deadline", "result"), [("3", date(2024, 1, 23), "Not Hit"), ("5", date(2024, 1, 25), "Hit SLA"), ("3 hari", None, None), ("3.5", None, None)])
def test_daily_report_delivery_sla(spark, sla, deadline, result):
    parcel = waybill("A", sender_city_name="X", recipient_city_name="Y", pod_record_time=utc("2024-01-24 00:00:00"))
    rows = report(
        spark,
        waybill_waybill=[parcel],
        masterdata_sla_shopee=[{"origin_city": "X", "destination_city": "Y", "sla": sla}],
    )
    assert (rows["A"]["lead_time_deliv"], rows["A"]["sla_est_deadline"], rows["A"]["sla_status_deliv"]) == (4, deadline, result)


def seller(spark, username="s1", **rows):
    t = tables(spark, system_option=OPTIONS, **rows)
    return by_key(plans.seller_performance(t, NOW, username=username))


def test_seller_report_keeps_only_the_account(spark):
    rows = {
        "order_order": [
            order("OPEN", parent_shipping_cleint="s1"),
            order("PICKED", parent_shipping_cleint="other", pickup_time=utc("2024-01-21 00:00:00")),
            order("LOST", parent_shipping_cleint="s1", pickup_time=utc("2024-01-21 00:00:00")),
            order("SHOPEE", parent_shipping_cleint="s1", order_source="0"),
            order(None, order_no="mine", parent_shipping_cleint="s1"),
            order(None, order_no="theirs", parent_shipping_cleint="s2", update_time=utc("2024-01-19 00:00:00")),
        ],
        "waybill_waybill": [
            waybill("PICKED", parent_shipping_cleint="s1", waybill_source="3"),
            waybill("LOST", parent_shipping_cleint="other", waybill_source="3"),
            waybill("ONLY", parent_shipping_cleint="s1", waybill_source="3"),
        ],
    }
    assert set(seller(spark, **rows)) == {"OPEN", "PICKED", None}
    everyone = seller(spark, username=None, **rows)
    assert set(everyone) == {"OPEN", "PICKED", "LOST", "ONLY", None}
    rows["order_order"][-1]["update_time"] = utc("2024-01-21 00:00:00")
    assert set(seller(spark, **rows)) == {"OPEN", "PICKED"}


def test_seller_report_sla_and_reason(spark):
    parcel = waybill(
        "A",
        parent_shipping_cleint="s1",
        sender_city_name="X",
        recipient_city_name="Y",
        recipient_province_name="NTT",
        cod_amount=Decimal(5),
        waybill_source="3",
    )
    rows = seller(
        spark,
        order_order=[order("A", parent_shipping_cleint="s1", input_time=utc("2024-01-20 08:00:00"))],
        waybill_waybill=[parcel],
        masterdata_sla_shopee=[{"origin_city": "X", "destination_city": "Y", "sla": "3"}],
        waybill_problem_piece=[
            {"waybill_no": "A", "operation_time": utc("2024-01-23 00:00:00"), "problem_reason": None, "problem_type": "01"}
        ],
        mitra_late_reason_delivery=[
            {"waybill_no": "A", "late_delivery_reason": "Late Arrival"},
            {"waybill_no": "A", "late_delivery_reason": "Zzz"},
        ],
    )
    a = rows["A"]
    assert (a["order_past_1400"], a["order_past_1500"], a["pickup_category_everpro"]) == (1, 1, "NextDay Pickup")
    assert (a["sla_pickup_soscom"], a["pickup_performance_everpro"]) == ("Late", "Late")
    assert (a["late_reason"], a["late_delivery_factor"], a["late_delivery_category"]) == ("Late Arrival", "IDE", "Controllable")
    assert (a["sla_performance"], a["problem_delivery_category"], a["final_status"]) == ("Not Hit", "Uncoverage", "Over SLA")
    assert (a["cod_type"], a["count_pos"]) == ("COD", None)


def test_seller_report_price_list_deadline_is_a_utc_date(spark):
    base = {
        "search_code": "c",
        "shipping_client_id": 1,
        "sender_location_id": 2,
        "recipient_location_id": 3,
        "express_type": "0",
        "deleted": "0",
        "end_expire_time": utc("2024-02-05 00:00:00"),
    }
    prices = [
        {**base, "max_sla": 9, "created_at": utc("2023-01-01 00:00:00")},
        {**base, "max_sla": 4, "created_at": utc("2023-02-01 00:00:00")},
        {**base, "max_sla": 1, "created_at": utc("2023-03-01 00:00:00"), "deleted": "1"},
        {**base, "max_sla": 2, "created_at": utc("2023-03-01 00:00:00"), "end_expire_time": utc("2024-01-31 10:00:00")},
    ]
    parcel = waybill(
        "A",
        waybill_source="2",
        vip_customer_id=1,
        sender_city_id=2,
        recipient_district_id=3,
        express_type="0",
        shipping_time=utc("2024-01-20 18:00:00"),
        pod_record_time=utc("2024-01-24 18:00:00"),
    )
    t = tables(spark, system_option=OPTIONS, waybill_waybill=[parcel], standard_shipping_fee=prices)
    row = plans.seller_performance(t, NOW, source="Blibli").collect()[0]
    assert (row["sla_delivery"], row["sla_est_deadline"]) == (4, date(2024, 1, 24))
    assert (row["lead_time_deliv"], row["sla_status"], row["sla_performance"]) == (4, "Hit SLA", "Not Hit")
    fixed = plans.seller_performance(t, NOW, source="Blibli", local_deadline=True).collect()[0]
    assert fixed["sla_performance"] == "Hit SLA"


def test_vip_check_pivots_attempts_and_needs_two_problems(spark):
    attempts = [scan("A", at, operation_type="09") for at in ("2024-01-21 00:00:00", "2024-01-21 00:00:00", "2024-01-22 00:00:00")]
    problems = [scan("A", at, operation_type="18") for at in ("2024-01-21 01:00:00", "2024-01-22 01:00:00")]
    t = tables(
        spark,
        system_option=OPTIONS,
        waybill_waybill=[
            waybill("A", waybill_source="3"),
            waybill("B", waybill_source="3"),
            waybill("C", waybill_source="3", waybill_status="1"),
            waybill("D", waybill_source="0"),
        ],
        waybill_waybill_line=[
            *attempts,
            *problems,
            scan("B", "2024-01-21 01:00:00", operation_type="18"),
            *[scan(k, at, operation_type="18") for k in "CD" for at in ("2024-01-21 01:00:00", "2024-01-22 01:00:00")],
        ],
        waybill_problem_piece=[
            {"waybill_no": "A", "operation_time": utc("2024-01-21 01:00:00"), "problem_reason": r, "problem_type": "01"}
            for r in ("first", "second")
        ],
    )
    rows = by_key(plans.vip_problem_check(t, NOW))
    assert set(rows) == {"A"}
    a = rows["A"]
    assert a["deliv_attempt_1"] == datetime(2024, 1, 21, 7)
    assert a["deliv_attempt_2"] is None, "two attempts at one time share number 1, so number 2 is skipped"
    assert (a["pos_reason_1"], a["pos_reason_2"]) == ("second", None)
    assert (a["count_pos_attempt"], a["count_deliv_attempt"]) == (2, 3)


def test_vip_revenue_groups_and_buckets(spark):
    def parcel(number, **more):
        return waybill(number, waybill_source="3", standard_shipping_fee=Decimal(10), parent_shipping_cleint="s", **more)

    t = tables(
        spark,
        system_option=OPTIONS,
        dm_waybill_waybill=[
            parcel("A"),
            parcel("B"),
            parcel("C", pod_record_time=utc("2024-01-22 20:00:00")),
            {**parcel("E"), "waybill_source": "0"},
        ],
        waybill_problem_piece=[
            {"waybill_no": "B", "operation_time": utc("2024-01-21 01:00:00"), "problem_reason": "x", "problem_type": "01"}
        ],
    )
    rows = plans.vip_revenue(t, NOW).collect()
    assert len(rows) == 3 and sum(r["total_pickup"] for r in rows) == 3
    open_row = next(r for r in rows if r["pos_reason"] == "x")
    assert (open_row["not_pod_with_pos"], open_row["aging_from_pickup_to_date"], open_row["aging_3_14day"]) == (1, 11, 1)
    done = next(r for r in rows if r["last_status"] == "Delivered")
    assert (done["leadtime_pickup_to_pod"], done["pod_without_pos"], done["aging_more_15day"]) == (3, 1, 0)
    assert done["source_category"] == "VIP Seller Amartha"
    assert done["gross_revenue"] == Decimal(10)


def test_courier_ledger_fallbacks_and_repeated_areas(spark):
    t = tables(
        spark,
        system_option=OPTIONS,
        waybill_waybill=[
            waybill("ZERO", pickup_courier_id=0, pickup_courier_name="", pickup_branch_id=1, pickup_branch_name="TH A"),
            waybill("NULL", pickup_branch_id=2, pickup_branch_name="MH A"),
            waybill("GONE", deleted="1"),
        ],
        dm_waybill_waybill=[
            waybill("ZERO", pod_record_time=utc("2024-01-22 00:00:00"), pod_courier_id=8, pod_branch_id=1, void_flag="1"),
            waybill("OPEN"),
        ],
        order_order=[
            order("ZERO", pickup_courier_id=6, pickup_courier_name="old", update_time=utc("2024-01-19 00:00:00")),
            order("ZERO", pickup_courier_id=7, pickup_courier_name="new"),
        ],
        res_user=[
            {"id": 7, "personnel_no": "P7", "enabled": "1", "deleted": "0"},
            {"id": 7, "personnel_no": "P7x", "enabled": "0", "deleted": "1"},
            {"id": 8, "personnel_no": "P8", "enabled": "0", "deleted": "0"},
        ],
        res_branch=[
            {"id": 1, "branch_no": "B1", "branch_level": "0", "city_id": 5},
            {"id": 2, "branch_no": "B2", "branch_level": "2", "city_id": 6},
        ],
        res_area=[
            {"city_id": 5, "province_name": "DKI JAKARTA"},
            {"city_id": 5, "province_name": "DKI JAKARTA"},
        ],
    )
    rows = {(r["waybill_no"], r["task_type"]): r for r in plans.courier_incentive(t, NOW).collect()}
    assert set(rows) == {("ZERO", "Pickup"), ("NULL", "Pickup"), ("ZERO", "POD")}
    zero = rows[("ZERO", "Pickup")]
    assert (zero["courier_id"], zero["courier_name"], zero["personnel_no"], zero["courier_status"]) == (7, "new", "P7", "active")
    assert (zero["kanwil_name"], zero["work_location"]) == ("Jakarta", "B1 - Jakarta TH A")
    assert (zero["pickup"], zero["pod"]) == (1, 0)
    assert (rows[("NULL", "Pickup")]["courier_id"], rows[("NULL", "Pickup")]["kanwil_name"]) == (None, "MH")
    assert (rows[("ZERO", "POD")]["courier_status"], rows[("ZERO", "POD")]["pod"]) == ("inactive", 1)


def test_cargo_reports(spark):
    def bag(number, at, **more):
        return scan(number, at, bag_no="BM1", vehicle_tag_no="VM1", **more)

    def parcel(number):
        return waybill(
            number,
            shipping_time=utc("2023-07-05 20:00:00"),
            standard_shipping_fee=Decimal(3),
            handling_fee=Decimal(2),
            item_calculated_weight=Decimal("1.5"),
        )

    def sheet(origin, bm, vm, **more):
        return {"report_date": "07/15/2023", "origin": origin, "destination_by_issued": "H1", "bm_code": bm, "vm_code": vm, **more}

    t = tables(
        spark,
        system_option=OPTIONS,
        waybill_waybill=[parcel("A"), parcel("B"), {**parcel("D"), "deleted": "1"}],
        waybill_waybill_line=[
            bag("A", "2023-06-20 00:00:00", operation_type="04", operation_branch_name="MH EARLY"),
            bag("A", "2023-07-10 18:00:00", operation_type="05", operation_branch_name="MH END"),
            bag("A", "2023-07-11 00:00:00", operation_type="05", operation_branch_name="TH END"),
            bag("B", "2023-07-10 00:00:00", operation_type="05"),
            bag("D", "2023-07-10 00:00:00"),
            bag("A", "2023-08-01 00:00:00", operation_type="04", operation_branch_name="MH LATE"),
            scan("A", "2023-07-10 00:00:00", bag_no="", vehicle_tag_no="VM1"),
            scan("A", "2023-07-10 00:00:00", vehicle_tag_no="VM1"),
        ],
        a_mh_facility_name_rnd=[{"mh_code": "H1", "mh_name": "MH ONE"}, {"mh_code": "H1", "mh_name": "MH UNO"}],
        smu_template_2=[sheet("CGK", "BM1", "VM1"), sheet("H1", "BM1", None), sheet("none", "BM9", "VM9")],
    )
    base = plans.cargo_base(t).collect()
    assert [r["waybill_no"] for r in base] == ["A", "B"]
    a = base[0]
    assert (a["mh_sending"], a["mh_arrival"], a["record_time"]) == ("MH EARLY", "MH END", date(2023, 7, 11))
    assert (a["shipping_time"], a["system_sf"]) == (date(2023, 7, 6), Decimal(5))
    hubs = {r["origin"]: r for r in plans.cargo_hubs(t).collect()}
    assert len(hubs) == 3
    assert (hubs["CGK"]["mh_sending_join"], hubs["H1"]["mh_sending_join"]) == ("MH JAKARTA", "MH ONE")
    assert hubs["none"]["mh_sending_join"] is None and hubs["H1"]["bm_vm_gsheet"] is None
    bags = {r["origin"]: r for r in plans.cargo_bags(plans.cargo_hubs(t), plans.cargo_base(t)).collect()}
    assert (bags["CGK"]["system_sf"], bags["CGK"]["system_weight"]) == (Decimal(10), Decimal(3))
    assert bags["H1"]["bag_no"] is None and bags["none"]["bag_no"] is None
    detail = plans.cargo_parcels(t["smu_template_2"], plans.cargo_base(t)).collect()
    assert sorted((r["origin"], r["waybill_no"] or "") for r in detail) == [("CGK", "A"), ("CGK", "B"), ("H1", ""), ("none", "")]
    assert detail[0]["return_flag"] is None
