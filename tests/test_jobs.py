"""Reports as jobs: marts are stored and read back by the reports that build on them."""

import argparse

import pytest

from parceltrail import plans
from parceltrail.checks import domain, mart_sql
from parceltrail.functions import pickup
from parceltrail.jobs import REPORTS, main, run
from parceltrail.sources.tables import SCHEMAS, Tables, read_mart


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("parcels"))
    t = domain.tables(spark, sf_dir)
    for name in SCHEMAS:
        t[name].write.parquet(f"{root}/{name}")
    return root


def options(root, marts, **more):
    base = dict(tables=root, marts=marts, as_of="2024-01-31T03:00:00Z", zone="Asia/Jakarta", sheet=None, username=None)
    period = dict.fromkeys(["first", "last", "sending_first", "shipped_first", "shipped_last"])
    rest = dict(check_keys=False, catalog=[], dated=[], source=pickup.SELLER_PORTAL, min_problems=2, hot_rows=None, incremental=False)
    return argparse.Namespace(**{**base, **period, **rest, **more})


def rows_of(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


def test_dwell_union_reads_the_stored_halves(spark, stored, tmp_path):
    marts = str(tmp_path)
    for name in ("longest_dwell_forward", "longest_dwell_returned", "longest_dwell_union"):
        run(spark, name, options(stored, marts, check_keys=True))
    t = Tables.from_parquet(spark, stored)
    halves = [plans.longest_dwell(t, domain.CLOCK, returned) for returned in (False, True)]
    want = plans.longest_dwell_union(*halves, domain.CLOCK)
    got = read_mart(spark, f"{marts}/longest_dwell_union")
    assert rows_of(got, want.columns) == rows_of(want)


def test_running_again_replaces_the_mart(spark, stored, tmp_path):
    for _ in range(2):
        run(spark, "return_backlog", options(stored, str(tmp_path)))
    want = plans.return_backlog(Tables.from_parquet(spark, stored), domain.CLOCK)
    assert read_mart(spark, f"{tmp_path}/return_backlog").count() == want.count()


def test_every_report_has_a_job():
    assert len(REPORTS) == 13


@pytest.mark.parametrize(
    ("module", "report"),
    [
        ("seller_performance", lambda t: plans.seller_performance(t, domain.CLOCK, username="seller3")),
        ("vip_check", lambda t: plans.vip_problem_check(t, domain.CLOCK)),
        ("returns", lambda t: plans.return_backlog(t, domain.CLOCK)),
    ],
)
def test_reports_do_not_depend_on_the_key_list(spark, stored, monkeypatch, module, report):
    import sys

    t = Tables.from_parquet(spark, stored)
    with_list = rows_of(report(t))
    monkeypatch.setattr(sys.modules[f"parceltrail.plans.{module}"], "having_key", lambda rows, keys, key: rows)
    assert rows_of(report(t)) == with_list


NEEDED = {
    "return_backlog": ["waybill_waybill", "waybill_return_bill", "system_option", "return_type", "mapping_kanwil_area"],
    "cargo_hubs": ["smu_template_2", "a_mh_facility_name_rnd"],
    "vip_problem_check": ["waybill_waybill", "waybill_waybill_line", "waybill_problem_piece", "system_option"],
}


@pytest.mark.parametrize("name", sorted(NEEDED))
def test_a_job_needs_only_the_tables_of_its_report(spark, stored, tmp_path, name):
    for needed in NEEDED[name]:
        spark.read.parquet(f"{stored}/{needed}").write.parquet(f"{tmp_path}/in/{needed}")
    run(spark, name, options(f"{tmp_path}/in", f"{tmp_path}/out"))
    assert read_mart(spark, f"{tmp_path}/out/{name}").count() > 0


def test_job_parameters(spark, stored, tmp_path):
    run(spark, "vip_problem_check", options(stored, f"{tmp_path}/two"))
    run(spark, "vip_problem_check", options(stored, f"{tmp_path}/many", min_problems=4))
    two, many = (read_mart(spark, f"{tmp_path}/{m}/vip_problem_check") for m in ("two", "many"))
    assert many.count() < two.count()
    assert rows_of(many) == rows_of(two.where("count_pos_attempt >= 4"))
    run(spark, "cargo_base", options(stored, f"{tmp_path}/cargo", **mart_sql.CARGO_PERIOD))
    want = plans.cargo_base(Tables.from_parquet(spark, stored), plans.CargoPeriod(**mart_sql.CARGO_PERIOD), ordered=False)
    got = read_mart(spark, f"{tmp_path}/cargo/cargo_base")
    assert rows_of(got, want.columns) == rows_of(want) and want.count() > 0


def test_a_catalog_table_stands_in_for_a_folder(spark, stored, tmp_path):
    spark.read.parquet(f"{stored}/smu_template_2").createOrReplaceTempView("sheet_view")
    spark.read.parquet(f"{stored}/a_mh_facility_name_rnd").createOrReplaceTempView("hub_view")
    named = ["smu_template_2=sheet_view", "a_mh_facility_name_rnd=hub_view"]
    run(spark, "cargo_hubs", options(None, str(tmp_path), catalog=named))
    want = plans.cargo_hubs(Tables.from_parquet(spark, stored))
    assert rows_of(read_mart(spark, f"{tmp_path}/cargo_hubs"), want.columns) == rows_of(want)


def test_arguments_reach_the_job(spark, stored, tmp_path):
    main(["cargo_hubs", "--tables", stored, "--marts", str(tmp_path), "--as-of", "2024-01-31T03:00:00Z", "--last", "2023-08-01"])
    assert read_mart(spark, f"{tmp_path}/cargo_hubs").count() > 0
