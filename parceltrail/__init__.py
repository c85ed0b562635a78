"""Parcel-logistics analytics as lazy PySpark DataFrame operators and report plans."""

from parceltrail.functions.clock import Clock
from parceltrail.sources.tables import Tables

__all__ = ["Clock", "Tables"]
