"""Pickup-failure and delivery-problem reasons: fixed value lists and the classifications built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parceltrail.functions.rules import by_value, contains_any, first_match

# ---------------------------------------------------------------------------------------------------------------
# Reason texts as the source systems record them. They must match the data letter by letter.
# ---------------------------------------------------------------------------------------------------------------

SENDER_PICKUP_REASONS = [
    "Pengiriman akan menggunakan ekspedisi lain",
    "Pengiriman dibatalkan",
    "Pengirim akan mengantar paket ke cabang",
    "Pengirim tidak ada di lokasi/toko",
    "Alamat pengirim kurang jelas",
    "Pengirim sedang mempersiapkan paket",
    "Pengirim meminta pergantian jadwal",
    "Paket belum ada/belum selesai dikemas",
    "Pengirim tidak dapat dihubungi",
    "Pengirim merasa tidak menggunakan iDexpress",
    "Pengirim sedang libur",
    "Pengirim sebagai dropshipper dan menunggu supplier",
    "Paket pre order",
    "Paket sedang disiapkan",
]
CANCELLED_BEFORE_PICKUP = "Pengiriman dibatalkan sebelum di pickup"
WEATHER = "Cuaca buruk / bencana alam"
OPERATOR_PICKUP_REASONS = [
    "Paket akan diproses dengan nomor resi yang baru",
    "Di luar cakupan area cabang, akan dijadwalkan ke cabang lain",
    "Melewati jam operasional cabang",
    "Late Schedule to Branch",
    "Late Schedule to Courier",
    "Kurir tidak available",
    "Late scan pickup",
]
NOT_A_DELIVERY_PROBLEM = [
    "Paket dikirim via ekspedisi lain",
    "Pengirim mengantarkan paket ke Drop Point",
    "Pengirim tidak di tempat",
    "Paket sedang disiapkan",
    "Pengirim akan mengantar paket ke cabang",
    "Pengirim tidak ada di lokasi/toko",
    "Alamat pengirim kurang jelas",
    "Pengirim sedang mempersiapkan paket",
    "Pengirim meminta pergantian jadwal",
    "Paket belum ada/belum selesai dikemas",
    "Pengirim tidak dapat dihubungi",
    "Pengirim merasa tidak menggunakan iDexpress",
    "Pengirim sedang libur",
    "Pengirim sebagai dropshipper dan menunggu supplier",
    "Paket pre order",
]
CUSTOMS_PARTS = ["bea cukai", "Rejected by customs"]
DAMAGED = [
    "Kemasan paket rusak",
    "Paket rusak/pecah",
    "Kerusakan pada resi / informasi resi tidak jelas",
    "Damaged parcels",
    "Information on AWB is unclear/damage",
    "Packaging is damage",
]
LOST = ["Paket hilang atau tidak ditemukan", "Parcels is lost or cannot be found", "Package is lost"]
MIXED_UP = ["Paket crosslabel"]
MISROUTED = ["Paket salah dalam proses penyortiran", "Data alamat tidak sesuai dengan kode sortir"]

CUSTOMS_CATEGORY = "Bea Cukai (Red Line)"
PROBLEM_CATEGORIES = {
    "Damaged": [*DAMAGED, "Kemasan paket tidak sesuai prosedur", "Pengemasan paket dengan kemasan rusak"],
    "Lost": [*LOST, "Paket Rusak"],
    "CrisCross": MIXED_UP,
    "Missroute": [
        *MISROUTED,
        "Paket akan dikembalikan ke cabang asal",
        "Paket salah dikirimkan/salah penyortiran",
    ],
    "Uncoverage": ["Di luar cakupan area cabang, akan dijadwalkan ke cabang lain"],
    "Bad address": ["Pelanggan ingin dikirim ke alamat berbeda", "Alamat pelanggan salah/sudah pindah alamat"],
    "Delivery attempt problem": [
        "Terdapat barang berbahaya (Dangerous Goods)",
        "Berat paket tidak sesuai",
        "Penerima ingin membuka paket sebelum membayar",
    ],
    "Force Majeur": [WEATHER],
    "Recipient cannot be contacted": [
        "Nomor telepon yang tertera tidak dapat dihubungi",
        "Nomor telepon yang tertera tidak dapat dihubungi atau alamat tidak jelas",
    ],
    "Recipient not at home": [
        "Pelanggan libur akhir pekan/libur panjang",
        "Reschedule pengiriman dengan penerima",
        "Toko atau kantor sudah tutup",
        "Pelanggan tidak di lokasi",
        "Sudah Reschedule dengan Customer",
        "Pelanggan tidak di tempat",
        "Kantor atau toko tutup",
        "Telepon bermasalah, tidak dapat dihubungi",
        "Penjadwalan Ulang",
    ],
    "Rejected by recipient": ["Penerima menolak menerima paket"],
    "Selfpickup by recipient": [
        "Pelanggan berinisiatif mengambil paket di cabang",
        "Penerima mengambil sendiri paket di DP",
    ],
    "Shipment cancellation": [
        "Pengiriman dibatalkan",
        "Paket akan diproses dengan nomor resi yang baru",
        "Pelanggan membatalkan pengiriman",
        "Pengiriman dibatalkan sebelum di pickup",
    ],
    "Shipment on hold": [
        "Penundaan jadwal armada pengiriman",
        "Paket makanan, disimpan hingga waktu pengiriman yang tepat",
        "Food parcels, kept until proper delivery time",
        "Melewati jam operasional cabang",
    ],
    "Other": [
        "Paket hilang ditemukan",
        "Pelanggan menunggu paket yang lain untuk dikirim",
        "Indikasi kecurangan pengiriman",
    ],
}
NARROW_CATEGORIES = {"Damaged": DAMAGED, "Lost": LOST, "CrisCross": MIXED_UP, "Missroute": MISROUTED}
HARD_TO_REACH_PROVINCES = ["PAPUA BARAT", "MALUKU UTARA", "PAPUA", "MALUKU", "NTB", "NTT"]
PICKUP_ATTEMPT_PROBLEM_TYPE = "Percobaan pengambilan terkendala"

OPERATOR_DELIVERY_REASONS = [
    "Paket akan diproses dengan nomor resi yang baru",
    "Paket salah dalam proses penyortiran",
    "Paket rusak/pecah",
    "Paket hilang atau tidak ditemukan",
    "Data alamat tidak sesuai dengan kode sortir",
    "Paket hilang ditemukan",
    "Pengemasan paket dengan kemasan rusak",
    "Paket crosslabel",
    "Melewati jam operasional cabang",
    "Kerusakan pada resi / informasi resi tidak jelas",
    "Kemasan paket rusak",
    "Paket akan dikembalikan ke cabang asal",
    "Kerusakan pada label pengiriman",
    "Paket salah sortir/ salah rute",
    "Di luar cakupan area cabang, akan dijadwalkan ke cabang lain",
    "Paket yang diterima dalam keadaan rusak",
    "Late Arrival",
    "Late scan POD",
]
COURIER_MISSING = "Kurir tidak available"
RECIPIENT_DELIVERY_REASONS = [
    "Pengiriman akan menggunakan ekspedisi lain",
    "Pengiriman dibatalkan",
    "Toko atau kantor sudah tutup",
    "Pelanggan tidak di lokasi",
    "Reschedule pengiriman dengan penerima",
    "Pelanggan membatalkan pengiriman",
    "Pelanggan ingin dikirim ke alamat berbeda",
    "Nomor telepon yang tertera tidak dapat dihubungi atau alamat tidak jelas",
    "Penerima menolak menerima paket",
    "Alamat pelanggan salah/sudah pindah alamat",
    "Penerima ingin membuka paket sebelum membayar",
    "Pelanggan libur akhir pekan/libur panjang",
    "Pelanggan menunggu paket yang lain untuk dikirim",
    "Pelanggan berinisiatif mengambil paket di cabang",
    "Kemasan paket tidak sesuai prosedur",
    "Pengirim membatalkan pengiriman",
    "Penerima tidak di tempat",
    "Penerima menjadwalkan ulang waktu pengiriman",
    "Penerima pindah alamat",
    "Penerima ingin mengambil paket di cabang",
    "Alamat tidak lengkap",
    "Penerima tidak dikenal",
    "Nomor telepon tidak dapat dihubungi",
]
EXTERNAL_DELIVERY_REASONS = [
    "Paket ditolak oleh bea cukai (red line)",
    "Terdapat barang berbahaya (Dangerous Goods)",
    "Cuaca buruk / bencana alam",
    "Penundaan jadwal armada pengiriman",
    "Indikasi kecurangan pengiriman",
    "Berat paket tidak sesuai",
    "Paket makanan, disimpan hingga waktu pengiriman yang tepat",
    "Food parcels, kept until proper delivery time",
    "Pengirim tidak dapat dihubungi",
    "bencana alam",
    "Cuaca buruk / Hujan",
]

PICKUP_FACTORS = {
    "External": [WEATHER],
    "IDE": OPERATOR_PICKUP_REASONS,
    "Pengirim": [*SENDER_PICKUP_REASONS, CANCELLED_BEFORE_PICKUP],
}
PICKUP_CONTROL = {
    "Controllable": OPERATOR_PICKUP_REASONS,
    "Uncontrollable": [WEATHER, *SENDER_PICKUP_REASONS, CANCELLED_BEFORE_PICKUP],
}
DELIVERY_FACTORS = {
    "IDE": [*OPERATOR_DELIVERY_REASONS, COURIER_MISSING],
    "Penerima": RECIPIENT_DELIVERY_REASONS,
    "External": EXTERNAL_DELIVERY_REASONS,
}
DELIVERY_CONTROL = {
    "Controllable": OPERATOR_DELIVERY_REASONS,
    "Uncontrollable": [*RECIPIENT_DELIVERY_REASONS, *EXTERNAL_DELIVERY_REASONS],
}

# ---------------------------------------------------------------------------------------------------------------


def sender_caused(reason: Column, including_cancelled: bool) -> Column:
    """Pickup failed for a reason on the sender's side."""
    extra = [CANCELLED_BEFORE_PICKUP] if including_cancelled else []
    return reason.isin(*SENDER_PICKUP_REASONS, *extra)


def pickup_factor(reason: Column) -> Column:
    """Who caused a late pickup; no reason counts as the operator."""
    return first_match([(reason.isNull(), "IDE"), *by_value(reason, PICKUP_FACTORS)])


def pickup_control(reason: Column) -> Column:
    return first_match([(reason.isNull(), "Controllable"), *by_value(reason, PICKUP_CONTROL)])


def is_customs(reason: Column) -> Column:
    return contains_any(reason, *CUSTOMS_PARTS)


def problem_category(reason: Column) -> Column:
    """The 16 delivery-problem classes."""
    return first_match([(is_customs(reason), CUSTOMS_CATEGORY), *by_value(reason, PROBLEM_CATEGORIES)])


def handling_problem(reason: Column) -> Column:
    """The reason itself when the operator damaged, lost, swapped or misrouted the parcel."""
    return F.when(reason.isin(*DAMAGED, *LOST, *MIXED_UP, *MISROUTED), reason)


def narrow_category(reason: Column, province: Column, cod_amount: Column) -> Column:
    """Handling class; otherwise cash-on-delivery parcels to far provinces are uncovered."""
    far_cod = province.isin(*HARD_TO_REACH_PROVINCES) & (cod_amount > 0)
    return first_match([*by_value(reason, NARROW_CATEGORIES), (far_cod, "Uncoverage")])


def order_system_problem(problem_type: Column, reason: Column) -> Column:
    return F.when(problem_type != PICKUP_ATTEMPT_PROBLEM_TYPE, reason)


def late_reason(reason: Column, partner_reason: Column) -> Column:
    """Delivery-side reason; sender-side reasons are blanked, a missing one falls back to the partner's."""
    return F.when(reason.isNull(), partner_reason).when(~reason.isin(*NOT_A_DELIVERY_PROBLEM), reason)


def delivery_factor(reason: Column) -> Column:
    return first_match([(reason.isNull(), "IDE"), *by_value(reason, DELIVERY_FACTORS)])


def delivery_control(reason: Column) -> Column:
    return first_match([(reason.isNull(), "Controllable"), *by_value(reason, DELIVERY_CONTROL)])
