"""Operator tools as column functions; each has a JSON form for callers that want text."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Tier edges in percent, air density, minimum useful output, service limits.
GOOD_PERCENT = 80
DEGRADED_PERCENT = 50
AIR_DENSITY = 1.225
MINIMUM_KW = 1000
SERVICE_DAYS = 90
SERVICE_ANOMALIES = 3

# Factor and shift per supported unit pair, result = value * factor + shift.
CONVERSIONS = {
    ("mph", "m/s"): (0.44704, 0.0),
    ("m/s", "mph"): (1 / 0.44704, 0.0),
    ("fahrenheit", "celsius"): (5 / 9, -160 / 9),
    ("celsius", "fahrenheit"): (9 / 5, 32.0),
    ("rpm", "rad_per_sec"): (math.pi / 30, 0.0),
    ("rad_per_sec", "rpm"): (30 / math.pi, 0.0),
}


def efficiency_percent(actual: Column, rated: Column) -> Column:
    """Output as percent of capacity; null where the capacity is not positive."""
    return F.when(rated > 0, F.round(actual / F.nullif(rated, F.lit(0.0)) * 100, 2))


def efficiency_tier(percent: Column) -> Column:
    return (
        F.when(percent >= GOOD_PERCENT, "good")
        .when(percent >= DEGRADED_PERCENT, "degraded")
        .when(percent.isNotNull(), "critical")
    )


def power_efficiency(actual: Column, rated: Column) -> Column:
    """JSON text with percentage and tier, or an error for a capacity that is not positive."""
    percent = efficiency_percent(actual, rated)
    good = F.to_json(F.struct(percent.alias("efficiency_pct"), efficiency_tier(percent).alias("status")))
    bad = F.to_json(F.struct(F.lit("capacity is not positive").alias("error")))
    return F.when(rated <= 0, bad).otherwise(good)


def wind_power_kw(speed: Column, diameter: Column) -> Column:
    area = math.pi * F.pow(diameter / 2, F.lit(2.0))
    return 0.5 * AIR_DENSITY * area * F.pow(speed, F.lit(3.0)) / 1000


def wind_power(speed: Column, diameter: Column) -> Column:
    power = wind_power_kw(speed, diameter)
    return F.to_json(
        F.struct(F.round(power, 2).alias("power_kw"), (power >= MINIMUM_KW).alias("meets_minimum"))
    )


def convert_units(value: Column, source: Column, target: Column) -> Column:
    """Converted value, null for an unsupported pair."""
    result = F.lit(None).cast("double")
    for (unit_from, unit_to), (factor, shift) in CONVERSIONS.items():
        hit = (F.lower(source) == unit_from) & (F.lower(target) == unit_to)
        result = F.when(hit, value * factor + shift).otherwise(result)
    return result


def unit_conversion(value: Column, source: Column, target: Column) -> Column:
    converted = convert_units(value, source, target)
    label = F.concat(source, F.lit(" to "), target)
    good = F.to_json(F.struct(converted.alias("value"), label.alias("conversion")))
    bad = F.to_json(F.struct(F.concat(F.lit("unsupported conversion: "), label).alias("error")))
    return F.when(converted.isNull(), bad).otherwise(good)


def urgency_level(days: Column, anomalies: Column) -> Column:
    late = days > SERVICE_DAYS
    noisy = anomalies > SERVICE_ANOMALIES
    return F.when(late & noisy, "urgent").when(late | noisy, "monitor").otherwise("ok")


def maintenance_urgency(days: Column, anomalies: Column) -> Column:
    level = urgency_level(days, anomalies)
    advice = (
        F.when(level == "urgent", "schedule service now")
        .when(level == "monitor", "watch and plan service")
        .otherwise("no action")
    )
    return F.to_json(F.struct(level.alias("urgency"), advice.alias("action")))
