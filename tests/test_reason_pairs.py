"""Reason texts and their classes, written out apart from the lists the reports use."""

import pytest
from pyspark.sql import functions as F

from parceltrail.functions import reasons

# Reason text -> delivery-problem class.
CATEGORY = {
    "Paket ditolak oleh bea cukai (red line)": "Bea Cukai (Red Line)",
    "Parcel was Rejected by customs": "Bea Cukai (Red Line)",
    "Kemasan paket rusak": "Damaged",
    "Paket rusak/pecah": "Damaged",
    "Damaged parcels": "Damaged",
    "Paket hilang atau tidak ditemukan": "Lost",
    "Parcels is lost or cannot be found": "Lost",
    "Package is lost": "Lost",
    "Paket Rusak": "Lost",
    "Paket crosslabel": "CrisCross",
    "Paket salah dalam proses penyortiran": "Missroute",
    "Data alamat tidak sesuai dengan kode sortir": "Missroute",
    "Paket akan dikembalikan ke cabang asal": "Missroute",
    "Paket salah dikirimkan/salah penyortiran": "Missroute",
    "Di luar cakupan area cabang, akan dijadwalkan ke cabang lain": "Uncoverage",
    "Pelanggan ingin dikirim ke alamat berbeda": "Bad address",
    "Alamat pelanggan salah/sudah pindah alamat": "Bad address",
    "Terdapat barang berbahaya (Dangerous Goods)": "Delivery attempt problem",
    "Berat paket tidak sesuai": "Delivery attempt problem",
    "Penerima ingin membuka paket sebelum membayar": "Delivery attempt problem",
    "Cuaca buruk / bencana alam": "Force Majeur",
    "Nomor telepon yang tertera tidak dapat dihubungi": "Recipient cannot be contacted",
    "Nomor telepon yang tertera tidak dapat dihubungi atau alamat tidak jelas": "Recipient cannot be contacted",
    "Pelanggan libur akhir pekan/libur panjang": "Recipient not at home",
    "Toko atau kantor sudah tutup": "Recipient not at home",
    "Penerima menolak menerima paket": "Rejected by recipient",
    "Pelanggan berinisiatif mengambil paket di cabang": "Selfpickup by recipient",
    "Penerima mengambil sendiri paket di DP": "Selfpickup by recipient",
    "Pengiriman dibatalkan": "Shipment cancellation",
    "Paket akan diproses dengan nomor resi yang baru": "Shipment cancellation",
    "Pelanggan membatalkan pengiriman": "Shipment cancellation",
    "Pengiriman dibatalkan sebelum di pickup": "Shipment cancellation",
    "Penundaan jadwal armada pengiriman": "Shipment on hold",
    "Paket makanan, disimpan hingga waktu pengiriman yang tepat": "Shipment on hold",
    "Food parcels, kept until proper delivery time": "Shipment on hold",
    "Melewati jam operasional cabang": "Shipment on hold",
    "Paket hilang ditemukan": "Other",
    "Pelanggan menunggu paket yang lain untuk dikirim": "Other",
    "Indikasi kecurangan pengiriman": "Other",
    "no such reason": None,
}
# Reason text -> who is to answer for a late delivery.
FACTOR_IS_OPERATOR = [
    "Paket akan diproses dengan nomor resi yang baru",
    "Paket salah dalam proses penyortiran",
    "Paket rusak/pecah",
    "Paket hilang atau tidak ditemukan",
    "Data alamat tidak sesuai dengan kode sortir",
]


def classed(spark, texts, rule):
    rows = spark.createDataFrame([(t,) for t in texts], "reason string").select("reason", rule(F.col("reason")).alias("c"))
    return {r.reason: r.c for r in rows.collect()}


def test_problem_classes(spark):
    assert classed(spark, CATEGORY, reasons.problem_category) == CATEGORY


def test_late_delivery_of_the_operator(spark):
    assert set(classed(spark, [None, *FACTOR_IS_OPERATOR], reasons.delivery_factor).values()) == {"IDE"}
    assert set(classed(spark, [None, *FACTOR_IS_OPERATOR], reasons.delivery_control).values()) == {"Controllable"}


@pytest.mark.parametrize("text", ["Paket belum ada/belum selesai dikemas", "Paket pre order", "Pengirim sedang libur"])
def test_sender_reasons_are_no_delivery_problem(spark, text):
    got = spark.createDataFrame([(text, "partner")], "r string, p string").select(reasons.late_reason(F.col("r"), F.col("p")))
    assert got.first()[0] is None
