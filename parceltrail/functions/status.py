"""Parcel status ladders, return backlog and aging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parceltrail.functions.delivery import SIGNED
from parceltrail.functions.pickup import CANCELLED
from parceltrail.functions.reasons import DAMAGED, LOST, NARROW_CATEGORIES, is_customs
from parceltrail.functions.rules import buckets, by_value, first_match

# Decoded labels of waybill states and flags.
VOID = "Void"
RETURN_RECEIVED = "Return Received"
RETURNED_FLAG = "Retur"
NOT_RETURNED_FLAG = "Tidak Retur"
CONFIRM_BACKLOG = "Backlog Confirm Return"
RETURN_BACKLOG = "Backlog Return"
RETURN_DONE = "POD Return"
AGING_BUCKETS = [
    (None, 2, "<3 Days"),
    (3, 7, "3-7 Days"),
    (8, 14, "8-14 Days"),
    (15, 30, "15-30 Days"),
    (31, None, ">30 Days"),
]


def _delivered(status: Column, delivered: Column) -> Column:
    return (status == SIGNED) | delivered.isNotNull()


def _returned(status: Column, return_delivered: Column) -> Column:
    return (status == RETURN_RECEIVED) | return_delivered.isNotNull()


def report_status(
    order_status: Column,
    status: Column,
    void: Column,
    delivered: Column,
    return_confirmed: Column,
    return_delivered: Column,
    return_flag: Column,
    reason: Column,
) -> Column:
    """Last status in the daily report. Void parcels are cancelled whatever else holds.

    The customs rule reads (open and local customs text) or (English customs text): the second part also catches
    parcels without a delivery state.
    """
    is_open = delivered.isNull()
    return first_match(
        [
            ((order_status == CANCELLED) | status.isNull() | (void == VOID), CANCELLED),
            (_delivered(status, delivered), "Delivered"),
            (_returned(status, return_delivered), "Returned"),
            (return_confirmed.isNotNull() & (return_flag == RETURNED_FLAG), "Return Process"),
            (is_open & reason.isin(*LOST), "Undelivered"),
            ((is_open & reason.contains("bea cukai")) | reason.contains("Rejected by customs"), "Undelivered"),
            (reason.isin(*DAMAGED), "Undelivered"),
        ],
        "Delivery Process",
    )


def _seller_common(
    order_status: Column, status: Column, void: Column, delivered: Column, return_delivered: Column
) -> list[tuple[Column, str]]:
    return [
        ((order_status == CANCELLED) | (void == VOID), CANCELLED),
        (status.isNull(), "Not Picked Up"),
        (_delivered(status, delivered), "Delivered"),
        (_returned(status, return_delivered), "Returned"),
    ]


def seller_status(
    order_status: Column,
    status: Column,
    void: Column,
    delivered: Column,
    return_confirmed: Column,
    return_delivered: Column,
    reason: Column,
) -> Column:
    """Last status in the seller report."""
    customs = status.contains("bea cukai") | reason.contains("Rejected by customs")
    return first_match(
        [
            *_seller_common(order_status, status, void, delivered, return_delivered),
            (customs | reason.isin(*DAMAGED, *LOST), "Undelivered"),
            (return_confirmed.isNotNull(), "Return Process"),
        ],
        "Delivery Process",
    )


def seller_final_status(
    order_status: Column,
    status: Column,
    void: Column,
    delivered: Column,
    return_confirmed: Column,
    return_delivered: Column,
    reason: Column,
) -> Column:
    """Final status in the seller report; what matches nothing is over its service level."""
    return first_match(
        [
            *_seller_common(order_status, status, void, delivered, return_delivered),
            (return_confirmed.isNotNull(), "Return Process"),
            (is_customs(reason), "Paket ditolak bea cukai (red line)"),
            *by_value(reason, NARROW_CATEGORIES),
        ],
        "Over SLA",
    )


def vip_status(status: Column, return_flag: Column, delivered: Column, return_delivered: Column) -> Column:
    return first_match(
        [
            (delivered.isNotNull(), "Delivered"),
            (return_delivered.isNotNull(), "Returned"),
            (return_flag == RETURNED_FLAG, "Return Process"),
            ((return_flag == NOT_RETURNED_FLAG) & ~status.isin(SIGNED, RETURN_RECEIVED), "Stuck"),
        ]
    )


def return_state(registered: Column, confirmed: Column, delivered: Column) -> Column:
    return F.when(
        registered.isNotNull(),
        first_match(
            [(confirmed.isNull(), CONFIRM_BACKLOG), (delivered.isNull(), RETURN_BACKLOG)],
            RETURN_DONE,
        ),
    )


def backlog_bucket(state: Column, wanted: str, aging: Column) -> Column:
    return F.when(state == wanted, buckets(aging, AGING_BUCKETS))
