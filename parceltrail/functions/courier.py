"""Courier zone and courier state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parceltrail.functions.rules import first_match

# Branch levels that follow the region, levels that name their own zone, and region labels.
REGIONAL_LEVELS = ["TH", "PDB"]
OWN_ZONE_LEVELS = ["MH", "Outlet", "Aggregator", "HQ", "Agent"]
SUMATRA_ZONES = {"SUMATERA BAGIAN UTARA": "Sumbagut", "SUMATERA BAGIAN SELATAN": "Sumbagsel"}
PROVINCE_ZONES = {"DKI JAKARTA": "Jakarta", "BANTEN": "Tangerang"}
REGION_ZONES = {
    "JAWA BARAT": "Jabar",
    "JAWA TENGAH": "Jawa Tengah",
    "JAWA TIMUR": "Jawa Timur",
    "KALIMANTAN": "Kalimantan",
    "SULAWESI": "Sulawesi",
    "3PL": "3PL",
}


def courier_zone(level: Column, region: Column, province: Column) -> Column:
    """Zone by region or province for district hubs, and by level for all other branches."""
    regional = first_match(
        [
            *((region == name, zone) for name, zone in SUMATRA_ZONES.items()),
            *((province == name, zone) for name, zone in PROVINCE_ZONES.items()),
            *((region == name, zone) for name, zone in REGION_ZONES.items()),
        ]
    )
    return F.when(level.isin(*REGIONAL_LEVELS), regional).when(level.isin(*OWN_ZONE_LEVELS), level)


def account_state(enabled: Column) -> Column:
    return F.when(enabled == "1", "active").when(enabled == "0", "inactive")


def any_account_active(first_enabled: Column, first_deleted: Column, *others: Column) -> Column:
    """Active when one account is enabled and one is undeleted; `others` continues (enabled, deleted) pairs."""
    enabled, undeleted = first_enabled == "1", first_deleted == "0"
    for i in range(0, len(others), 2):
        enabled, undeleted = enabled | (others[i] == "1"), undeleted | (others[i + 1] == "0")
    return F.when(enabled & undeleted, "active").otherwise("inactive")
