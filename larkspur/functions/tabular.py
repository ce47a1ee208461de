"""Row-wise features, bands and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import strip

# Labels and right-closed upper bounds of the tenure bins.
TENURE_BINS = [
    ("0-6 months", 6),
    ("7-12 months", 12),
    ("13-24 months", 24),
    ("25-48 months", 48),
    ("49+ months", None),
]
# Risk bands and their left-closed lower bounds.
RISK_LOW_MAX = 0.30
RISK_MEDIUM_MAX = 0.60
# The suggested action per risk band, and the one for any other band.
RISK_ACTIONS = {
    "High": "Prioritize the customer for retention review and proactive outreach.",
    "Medium": "Consider proactive engagement, support follow-up, or targeted communication.",
    "Low": "Continue normal service and monitoring.",
}
DEFAULT_ACTION = "Review the customer profile."


def without_nan(x: Column) -> Column:
    """NaN as NULL: Spark orders NaN above all numbers, so it must not stay in."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def row_mean(*columns: Column) -> Column:
    """Mean of the present values of a row; NULL if there are none."""
    total, present = F.lit(0.0), F.lit(0)
    for column in columns:
        total = total + F.coalesce(column.cast("double"), F.lit(0.0))
        present = present + column.isNotNull().cast("int")
    return F.when(present > 0, total / present)


def in_range(x: Column, low: float = 0, high: float = 100) -> Column:
    """Values outside [low, high] become NULL."""
    return F.when(x.between(low, high), x)


def performance_category(score: Column) -> Column:
    score = without_nan(score)
    return (
        F.when(score.isNull(), "Unknown").when(score >= 70, "High").when(score >= 50, "Medium").otherwise("Low")
    )


def avg_monthly_spend(tenure: Column, total: Column, monthly: Column) -> Column:
    """Total over tenure, or the monthly charge where tenure is zero or missing."""
    return F.when(tenure > 0, total / tenure).otherwise(monthly)


def tenure_group(tenure: Column) -> Column:
    out = F.when(tenure <= -1, F.lit(None).cast("string"))
    for label, upper in TENURE_BINS:
        out = out.when(tenure.isNotNull() if upper is None else tenure <= upper, label)
    return out


def tenure_ordinal(group: Column) -> Column:
    """Position of a tenure label in bin order, from 1."""
    labels = F.array(*[F.lit(label) for label, _ in TENURE_BINS])
    return F.nullif(F.array_position(labels, group), F.lit(0)).cast("int")


def is_new_customer(tenure: Column) -> Column:
    return F.when(tenure <= 6, "Yes").otherwise("No")


def count_yes(*columns: Column) -> Column:
    """How many of the columns read ``yes``, whatever their case and outer blanks."""
    total = F.lit(0)
    for column in columns:
        total = total + F.coalesce((F.lower(strip(column)) == "yes").cast("int"), F.lit(0))
    return total


def risk_band(probability: Column, low_max: float = RISK_LOW_MAX, medium_max: float = RISK_MEDIUM_MAX) -> Column:
    return F.when(probability < low_max, "Low").when(probability < medium_max, "Medium").when(
        probability.isNotNull(), "High"
    )


def predicted_status(predicted: Column) -> Column:
    # The two texts.
    return F.when(predicted == 1, "Likely to Churn").otherwise("Likely to Stay")
