"""The metric catalog: a fixed dimension table of 41 rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SCHEMA = (
    "metric_name string, display_name string, subject_area string, metric_group string, "
    "value_type string, default_unit string, description string, aggregation_method string, "
    "is_additive boolean, lower_is_better boolean, is_realtime boolean, default_granularity string, "
    "numerator_metric string, denominator_metric string, sample_metric string, notes string"
)

# Name, display name, area, group, type, unit, lower is better, real time,
# numerator, denominator. A row with a numerator is a weighted average, any other a sum;
# real-time rows default to MINUTE, the rest to DAY.
ROWS = [
    ("new_passenger", "New Passenger", "Passenger", "Acquisition", "COUNT", "COUNT", False, False, None, None),
    ("active_passenger", "Active Passenger", "Passenger", "Engagement", "COUNT", "COUNT", False, False, None, None),
    ("retention_passenger", "Retention Passenger", "Passenger", "Retention", "COUNT", "COUNT", False, False, None, None),
    ("retention_rate_passenger", "Retention Rate", "Passenger", "Retention", "PERCENT", "PERCENT", False, False, "retention_passenger", "active_passenger_prev"),
    ("churn_passenger", "Churn Passenger", "Passenger", "Retention", "COUNT", "COUNT", True, False, None, None),
    ("return_passenger", "Return Passenger", "Passenger", "Retention", "COUNT", "COUNT", False, False, None, None),
    ("churn_rate_passenger", "Churn Rate", "Passenger", "Retention", "PERCENT", "PERCENT", True, False, "churn_passenger", "active_passenger_tminus3"),
    ("new_driver", "New Driver", "Driver", "Acquisition", "COUNT", "COUNT", False, False, None, None),
    ("active_driver", "Active Driver", "Driver", "Engagement", "COUNT", "COUNT", False, False, None, None),
    ("online_driver", "Online Driver", "Driver", "Availability", "COUNT", "COUNT", False, True, None, None),
    ("busy_driver", "Busy Driver", "Driver", "Availability", "COUNT", "COUNT", False, True, None, None),
    ("retention_driver", "Retention Driver", "Driver", "Retention", "COUNT", "COUNT", False, False, None, None),
    ("retention_rate_driver", "Driver Retention Rate", "Driver", "Retention", "PERCENT", "PERCENT", False, False, "retention_driver", "active_driver_prev"),
    ("churn_driver", "Churn Driver", "Driver", "Retention", "COUNT", "COUNT", True, False, None, None),
    ("churn_rate_driver", "Driver Churn Rate", "Driver", "Retention", "PERCENT", "PERCENT", True, False, "churn_driver", "active_driver_tminus3"),
    ("return_driver", "Return Driver", "Driver", "Retention", "COUNT", "COUNT", False, False, None, None),
    ("productivity", "Productivity", "Driver", "Efficiency", "RATIO", "TRIP_PER_DRIVER", False, False, "completed_order", "active_driver"),
    ("net_driver_income", "Net Driver Income", "Driver", "Finance", "CURRENCY", "CURRENCY", False, True, None, None),
    ("request_order", "Request Order", "Operation", "Demand", "COUNT", "COUNT", False, True, None, None),
    ("accept_order", "Accept Order", "Operation", "Fulfillment", "COUNT", "COUNT", False, True, None, None),
    ("acceptance_rate", "Acceptance Rate", "Operation", "Fulfillment", "PERCENT", "PERCENT", False, True, "accept_order", "request_order"),
    ("completed_order", "Completed Order", "Operation", "Fulfillment", "COUNT", "COUNT", False, True, None, None),
    ("completed_rate", "Completed Rate", "Operation", "Fulfillment", "PERCENT", "PERCENT", False, True, "completed_order", "request_order"),
    ("gsv", "Gross Service Value", "Operation", "Finance", "CURRENCY", "CURRENCY", False, True, None, None),
    ("revenue_vat", "Revenue include VAT", "Operation", "Finance", "CURRENCY", "CURRENCY", False, True, None, None),
    ("revenue_net", "Revenue", "Operation", "Finance", "CURRENCY", "CURRENCY", False, True, None, None),
    ("cancel_order", "Cancel Order", "Operation", "Fulfillment", "COUNT", "COUNT", True, True, None, None),
    ("cancel_rate", "Cancellation Rate", "Operation", "Fulfillment", "PERCENT", "PERCENT", True, True, "cancel_order", "request_order"),
    ("order_time", "Order Time", "Operation", "Time", "DURATION", "SECOND", True, True, "order_time_total", "completed_order"),
    ("board_time", "Board Time", "Operation", "Time", "DURATION", "SECOND", True, True, "board_time_total", "completed_order"),
    ("accept_time", "Accept Time", "Operation", "Time", "DURATION", "SECOND", True, True, "accept_time_total", "request_order"),
    ("lead_time", "Lead Time", "Operation", "Time", "DURATION", "SECOND", True, True, "lead_time_total", "completed_order"),
    ("discount_order", "Discount Order", "Operation", "Finance", "CURRENCY", "CURRENCY", True, True, None, None),
    ("order_time_total", "Order Time Total", "Derived", "Support", "DURATION", "SECOND", True, True, None, None),
    ("board_time_total", "Board Time Total", "Derived", "Support", "DURATION", "SECOND", True, True, None, None),
    ("accept_time_total", "Accept Time Total", "Derived", "Support", "DURATION", "SECOND", True, True, None, None),
    ("lead_time_total", "Lead Time Total", "Derived", "Support", "DURATION", "SECOND", True, True, None, None),
    ("active_passenger_prev", "Active Passenger t-1", "Derived", "Support", "COUNT", "COUNT", False, False, None, None),
    ("active_passenger_tminus3", "Active Passenger t-3", "Derived", "Support", "COUNT", "COUNT", False, False, None, None),
    ("active_driver_prev", "Active Driver t-1", "Derived", "Support", "COUNT", "COUNT", False, False, None, None),
    ("active_driver_tminus3", "Active Driver t-3", "Derived", "Support", "COUNT", "COUNT", False, False, None, None),
]

# Fixed values allowed in three catalog columns.
VALUE_TYPES = ["COUNT", "CURRENCY", "PERCENT", "RATIO", "DURATION", "INTEGER", "FLOAT"]
AGGREGATION_METHODS = ["SUM", "WEIGHTED_AVG", "LATEST"]
GRANULARITIES = ["MINUTE", "HOUR", "DAY", "WEEK", "MONTH"]

UNITS = {row[0]: row[5] for row in ROWS}


def metric_catalog(spark: SparkSession) -> DataFrame:
    """The catalog as a frame. It is a constant, so joins may broadcast it."""
    rows = [
        (name, display, area, group, kind, unit, None,
         "WEIGHTED_AVG" if num else "SUM", num is None, lower, live, "MINUTE" if live else "DAY",
         num, den, None, None)
        for name, display, area, group, kind, unit, lower, live, num, den in ROWS
    ]
    return spark.createDataFrame(rows, SCHEMA)


def is_valid() -> Column:
    """True where a catalog row keeps to the allowed values."""
    return (
        F.col("value_type").isin(VALUE_TYPES)
        & F.col("aggregation_method").isin(AGGREGATION_METHODS)
        & F.col("default_granularity").isin(GRANULARITIES)
    )
