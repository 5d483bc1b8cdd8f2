"""Descriptions of the coded columns. A code without an entry gives null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The texts stored in the warehouse, spelled as they are stored there.
VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negoriated fare",
    6: "Group ride",
}
PAYMENTS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
SERVICE_NAMES = {
    1: "Yellow",
    2: "Green",
}


def describe(code: Column | str, texts: Mapping[int, str]) -> Column:
    """Text for ``code``; null where ``texts`` has no entry."""
    code = F.col(code) if isinstance(code, str) else code
    out = F.lit(None).cast("string")
    for value, text in texts.items():
        out = F.when(code == value, F.lit(text)).otherwise(out)
    return out


def vendor_name(code: Column | str, texts: Mapping[int, str] = VENDORS) -> Column:
    return describe(code, texts)


def rate_code_description(code: Column | str, texts: Mapping[int, str] = RATE_CODES) -> Column:
    return describe(code, texts)


def payment_description(code: Column | str, texts: Mapping[int, str] = PAYMENTS) -> Column:
    return describe(code, texts)


def service_name(code: Column | str, texts: Mapping[int, str] = SERVICE_NAMES) -> Column:
    return describe(code, texts)
