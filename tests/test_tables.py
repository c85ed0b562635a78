from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import table, tables, utc
from parceltrail.sources.sheets import read_sheet, rejected_rows
from parceltrail.sources.tables import SCHEMAS, Tables, duplicate_keys, read_mart, write_mart


def test_unique_keys_are_checked(spark):
    row = {"province_name": "BALI", "kanwil_name": "a"}
    tables(spark, mapping_kanwil_area=[row]).check_unique()
    twice = tables(spark, mapping_kanwil_area=[row, {**row, "kanwil_name": "b"}])
    with pytest.raises(ValueError, match="mapping_kanwil_area"):
        twice.check_unique()
    assert duplicate_keys(twice["mapping_kanwil_area"], ["province_name"]).count() == 1


def test_deleted_rows_do_not_count_as_duplicates(spark):
    rows = [{"id": 1, "deleted": "0"}, {"id": 1, "deleted": "1"}]
    tables(spark, res_user=rows).check_unique("res_user")


def test_session_zone_must_be_utc(spark):
    frame = table(spark, "res_user", [])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Tables({"res_user": frame})
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sheet_is_read_from_csv(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    names = SCHEMAS["smu_template_2"].fieldNames()
    values = ["07/15/2023", "CGK", "H1", "H2", "3", "1.5", "BM1", "VM1", "Java", "S1", "100", "F1", "A", "V"]
    path.write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    row = read_sheet(spark, str(path)).first()
    assert (row["report_date"], row["no_of_packages"], float(row["smu_weight"])) == ("07/15/2023", 3, 1.5)


GOOD = ["07/15/2023", "CGK", "H1", "H2", "3", "1.5", "BM1", "VM1", "Java", "S1", "100", "F1", "A", "V"]


@pytest.mark.parametrize(
    ("place", "cell", "reason"),
    [
        (4, "three", "no_of_packages is no number"),
        (4, "3.7", "no_of_packages is no number"),
        (5, "1,5", "smu_weight is no number"),
        (5, "1e400", "smu_weight is no number"),
        (10, "Rp 100", "total_smu_fee is no number"),
        (0, "2023-07-15", "report_date is no date"),
        (0, "13/45/2023", "report_date is no date"),
        (0, None, None),
        (4, None, None),
        (4, " 3 ", None),
        (6, "not a number", None),
    ],
)
def test_a_bad_cell_is_reported_and_never_null(spark, tmp_path, place, cell, reason):
    path, cells = tmp_path / "sheet.csv", [*GOOD]
    cells[place] = "" if cell is None else f'"{cell}"'
    path.write_text("\n".join([",".join(SCHEMAS["smu_template_2"].fieldNames()), ",".join(GOOD), ",".join(cells)]) + "\n")
    rejected = rejected_rows(spark, str(path)).collect()
    assert read_sheet(spark, str(path)).count() == (2 if reason is None else 1)
    assert [r["reason"] for r in rejected] == ([] if reason is None else [reason])
    assert all(cell in r["line"] for r in rejected)


def test_rows_of_other_widths_are_rejected_whole(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    lines = [",".join(SCHEMAS["smu_template_2"].fieldNames()), ",".join(GOOD), ",".join(GOOD[:9]), ",".join([*GOOD, "more"])]
    path.write_text("\n".join(lines) + "\n")
    assert read_sheet(spark, str(path)).count() == 1
    assert {(r["line"], r["reason"]) for r in rejected_rows(spark, str(path)).collect()} == {
        (lines[2], "wrong number of cells"),
        (lines[3], "wrong number of cells"),
    }


def test_parquet_and_catalog_readers(spark, tmp_path):
    rows = table(spark, "waybill_waybill_line", [{"waybill_no": "A", "record_time": utc("2024-01-01 00:00:00"), "operation_type": "09"}])
    rows.write.parquet(str(tmp_path / "waybill_waybill_line"))
    t = Tables.from_parquet(spark, str(tmp_path), ["waybill_waybill_line"])
    assert t["waybill_waybill_line"].first()["operation_type"] == "09"
    rows.withColumn("extra", F.lit(1)).createOrReplaceTempView("scan_log")
    found = Tables.from_catalog(spark, {"waybill_waybill_line": "scan_log"})["waybill_waybill_line"]
    assert found.columns == SCHEMAS["waybill_waybill_line"].fieldNames()


@pytest.mark.parametrize(
    ("only_partitions", "left"),
    [(False, {(date(2024, 1, 2), 3)}), (True, {(date(2024, 1, 1), 1), (date(2024, 1, 2), 3)})],
)
def test_mart_overwrite(spark, tmp_path, only_partitions, left):
    target = str(tmp_path / "mart")
    columns = "day date, n int"
    write_mart(spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)], columns), target, ["day"])
    again = spark.createDataFrame([(date(2024, 1, 2), 3)], columns)
    write_mart(again, target, ["day"], only_partitions=only_partitions)
    assert {(r["day"], r["n"]) for r in read_mart(spark, target).collect()} == left


def test_wall_clocks_survive_a_mart(spark, tmp_path):
    target = str(tmp_path / "walls")
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 09:00:00' AS at")
    write_mart(rows, target)
    assert read_mart(spark, target).first()["at"] == datetime(2024, 1, 1, 9)


def test_catalog_mart(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}/marts'")
    columns = "n int, day date"
    first = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], columns)
    try:
        write_mart(first, "marts.daily", ["day"], table=True)
        write_mart(first.where("n = 2").selectExpr("n + 1 AS n", "day"), "marts.daily", ["day"], True, only_partitions=True)
        assert {r["n"] for r in read_mart(spark, "marts.daily", table=True).collect()} == {1, 3}
        write_mart(first.where("n = 2"), "marts.daily", ["day"], table=True)
        assert {r["n"] for r in read_mart(spark, "marts.daily", table=True).collect()} == {2}
    finally:
        spark.sql("DROP DATABASE marts CASCADE")
