"""Revenue columns of a completed booking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: VAT share of the platform fee.
VAT_RATE = 0.10
NET_FACTOR = 1.0 / (1.0 + VAT_RATE)


def gross_service_value(fee: Column, discount: Column) -> Column:
    return fee + discount


def revenue_net(fee: Column) -> Column:
    return fee * F.lit(NET_FACTOR)


def net_driver_income(fee: Column, discount: Column) -> Column:
    """Gross value less the fee, never negative. By this rule it equals the discount."""
    return F.greatest(F.lit(0.0), gross_service_value(fee, discount) - fee)
