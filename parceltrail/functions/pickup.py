"""Pickup service levels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from parceltrail.functions.clock import DEFAULT_ZONE, date_of, local_date, plus_days
from parceltrail.functions.reasons import sender_caused
from parceltrail.functions.rules import first_match
from parceltrail.functions.values import exactly_one

# Decoded labels of order sources, order states and services.
SHOPEE = "Shopee platform"
TOKOPEDIA = "Tokopedia"
BLIBLI = "Blibli"
MARKETPLACES = [SHOPEE, BLIBLI, TOKOPEDIA]
SELLER_PORTAL = "VIP Customer Portal"
CANCELLED = "Cancel Order"
PICKED_UP = "Picked Up"
PICKUP_SERVICE = "Pick up"


def pickup_days(pickup: Column, start: Column, placed: Column, tz: str = DEFAULT_ZONE) -> Column:
    """Local days from the planned start (or, without one, from order input) to pickup; arguments are instants."""
    return F.datediff(local_date(pickup, tz), local_date(F.coalesce(start, placed), tz))


def _against_due(
    done: Column, due_done: Column, today: Column, due_open: Column, waiting: str, cancelled: Column | None = None
) -> Column:
    """On Time / Late for finished pickups; waiting label / Late (or Cancel Order) for open ones."""
    rules: list[tuple[Column, str]] = [
        (done.isNotNull() & (done <= due_done), "On Time"),
        (done.isNotNull() & (done > due_done), "Late"),
    ]
    if cancelled is not None:
        rules.append((done.isNull() & cancelled, CANCELLED))
    rules += [
        (done.isNull() & (today <= due_open), waiting),
        (done.isNull() & (today > due_open), "Late"),
    ]
    return first_match(rules)


def generic_sla(service: Column, pickup: Column, end: Column, today: date, inverted: bool = False) -> Column:
    """Pickup-service orders against the end of their slot.

    `inverted` swaps the two labels of open orders, as the daily report does: a slot still ahead is Late there.
    """
    midnight = F.lit(today).cast("timestamp_ntz")
    if not inverted:
        return F.when(service == PICKUP_SERVICE, _against_due(pickup, end, midnight, end, "Not Pick up Yet"))
    return F.when(
        service == PICKUP_SERVICE,
        first_match(
            [
                (pickup <= end, "On Time"),
                (pickup > end, "Late"),
                (pickup.isNull() & (end > midnight), "Late"),
                (pickup.isNull() & (end <= midnight), "Not Pick up Yet"),
            ]
        ),
    )


def shopee_sla(source: Column, status: Column, pickup: Column, start: Column, today: date) -> Column:
    """Until the day after the planned start; cancelled orders are out."""
    due = plus_days(date_of(start), 1)
    return F.when(
        (source == SHOPEE) & (status != CANCELLED),
        _against_due(date_of(pickup), due, F.lit(today), due, "Not Pick Up Yet"),
    )


def tokopedia_sla(
    source: Column, status: Column, pickup: Column, start: Column, end: Column, today: date
) -> Column:
    """Until the slot end; open orders wait until the slot start."""
    midnight = F.lit(today).cast("timestamp_ntz")
    return F.when(
        (source == TOKOPEDIA) & (status != CANCELLED),
        _against_due(pickup, end, midnight, start, "Not Pick Up Yet"),
    )


def blibli_sla(
    source: Column, status: Column, pickup: Column, base: Column, past_1400: Column, today: date
) -> Column:
    """Same day, or next day after the 14:00 cut-off, counted from `base` (planned start or order input)."""
    due = plus_days(date_of(base), past_1400)
    return F.when(
        source == BLIBLI,
        _against_due(date_of(pickup), due, F.lit(today), due, "Not Picked Up", status == CANCELLED),
    )


def other_sla(
    source: Column, status: Column, pickup: Column, placed: Column, past_1500: Column, today: date
) -> Column:
    """All other sources: same day, or next day after the 15:00 cut-off."""
    due = plus_days(date_of(placed), past_1500)
    return F.when(
        ~source.isin(*MARKETPLACES),
        _against_due(date_of(pickup), due, F.lit(today), due, "Not Picked Up", status == CANCELLED),
    )


def selected_sla(*variants: Column) -> Column:
    """The one source-specific result that is set."""
    return exactly_one(*variants)


def pickup_category(source: Column, past_1400: Column, past_1500: Column) -> Column:
    def label(past: Column) -> Column:
        return F.when(past == 1, "NextDay Pickup").when(past == 0, "SameDay Pickup")

    return F.when(source == BLIBLI, label(past_1400)).when(~source.isin(*MARKETPLACES), label(past_1500))


def adjusted_by_time_or_reason(
    source: Column, sla: Column, failure: Column, end: Column, reason: Column
) -> Column:
    """Late pickups are excused by a failed attempt before the slot end, or by a sender-side reason."""
    late = sla == "Late"
    excused = (late & (failure < end)) | ((source != TOKOPEDIA) & late & sender_caused(reason, True))
    return F.when(excused, "Adjusted").otherwise(sla)


def adjusted_by_reason(source: Column, sla: Column, failure: Column, end: Column, reason: Column) -> Column:
    """Late pickups are excused by a sender-side reason; one source also needs the attempt before the slot end."""
    late = sla == "Late"
    excused = ((source == TOKOPEDIA) & late & (failure <= end) & sender_caused(reason, False)) | (
        (source != TOKOPEDIA) & late & sender_caused(reason, True)
    )
    return F.when(excused, "Adjusted").otherwise(sla)


def pickup_rate(days: Column, same_day: str) -> Column:
    return first_match(
        [(days < 0, "Early Pickup"), (days == 0, same_day), (days == 1, "H+1"), (days == 2, "H+2"), (days > 2, "H2+")]
    )


def pickup_status(status: Column) -> Column:
    return F.when(status.isin(CANCELLED, PICKED_UP), status).when(status.isNotNull(), "Not Picked Up")


def first_mile(status: Column) -> Column:
    return F.when(status == PICKED_UP, PICKED_UP).otherwise("Failed Pickup")


def owner(source: Column, by_seller: Column, by_source: Column) -> Column:
    """Sales owner: from the seller table for the seller portal, else from the source table."""
    return F.when(source == SELLER_PORTAL, by_seller).otherwise(by_source)


