"""Functions callable from SQL: temporary SQL functions and vectorised Python ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.functions import tools
from telemetra.functions.columns import RULE_INPUTS, RULE_SPREAD, RULE_STRONG, RULE_WEAK


def register_rule_udf(spark: SparkSession, name: str = "predict_fault"):
    """The scoring rule as an Arrow-batched function, the form a Python-only model would take.

    ``inputs`` on the returned function lists the columns it expects, in order.
    """

    @F.pandas_udf("string")
    def score(mean: pd.Series, spread: pd.Series) -> pd.Series:
        choices = np.select(
            [spread > RULE_SPREAD, mean < RULE_WEAK, mean > RULE_STRONG],
            ["channel_b", "channel_d", "channel_f"],
            default="ok",
        )
        return pd.Series(choices)

    spark.udf.register(name, score)
    score.inputs = list(RULE_INPUTS)
    return score


def register_rule_sql(spark: SparkSession, name: str = "fault_of") -> str:
    """The same rule as a SQL function; Spark inlines it into the calling plan."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(mean DOUBLE, spread DOUBLE)
        RETURNS STRING
        RETURN CASE WHEN spread > {RULE_SPREAD}D THEN 'channel_b'
                    WHEN mean < {RULE_WEAK}D THEN 'channel_d'
                    WHEN mean > {RULE_STRONG}D THEN 'channel_f' ELSE 'ok' END"""
    )
    return name


def register_spec_lookup(spark: SparkSession, specs: DataFrame, name: str = "asset_spec") -> str:
    """Look up one asset as a struct. ``specs`` must be unique on asset_id.

    On a column of ids Spark turns the scalar subquery into a left join.
    """
    view = f"{name}_source"
    specs.createOrReplaceTempView(view)
    fields = ", ".join(f"'{c}', s.{c}" for c in specs.columns)
    returns = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in specs.schema)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(asset_id BIGINT)
        RETURNS STRUCT<{returns}>
        RETURN (SELECT any_value(named_struct({fields})) FROM {view} s
                WHERE s.asset_id = {name}.asset_id)"""
    )
    return name


def register_readings_of(spark: SparkSession, readings: DataFrame, name: str = "readings_of") -> str:
    """Table function with the readings of one asset."""
    view = f"{name}_source"
    readings.createOrReplaceTempView(view)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted BIGINT)
        RETURNS TABLE(event_id BIGINT, event_time TIMESTAMP, energy DOUBLE)
        RETURN SELECT event_id, event_time, energy FROM {view} WHERE asset_id = wanted"""
    )
    return name


def register_answers(spark: SparkSession, answers: DataFrame, name: str = "guides_for") -> str:
    """Array of retrieved texts for a question; ``answers`` holds question_id, position, guide."""
    view = f"{name}_source"
    answers.createOrReplaceTempView(view)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(question BIGINT)
        RETURNS ARRAY<STRING>
        RETURN (SELECT transform(array_sort(collect_list(struct(a.position, a.guide))), x -> x.guide)
                FROM {view} a WHERE a.question_id = {name}.question)"""
    )
    return name


def register_tools(spark: SparkSession) -> list[str]:
    """The operator tools and the histogram bin as SQL functions; returns their names."""
    percent = "round(actual_kw / nullif(rated_kw, 0D) * 100, 2)"
    branches = " ".join(
        f"WHEN lower(source) = '{a}' AND lower(target) = '{b}' THEN amount * {factor!r}D + {shift!r}D"
        for (a, b), (factor, shift) in tools.CONVERSIONS.items()
    )
    level = (
        f"CASE WHEN days > {tools.SERVICE_DAYS} AND anomalies > {tools.SERVICE_ANOMALIES} THEN 'urgent' "
        f"WHEN days > {tools.SERVICE_DAYS} OR anomalies > {tools.SERVICE_ANOMALIES} THEN 'monitor' "
        "ELSE 'ok' END"
    )
    bodies = {
        "power_efficiency(actual_kw DOUBLE, rated_kw DOUBLE) RETURNS STRING "
        "COMMENT 'Output as percent of capacity, with a tier, as JSON'": f"""
            CASE WHEN rated_kw <= 0 THEN
                to_json(named_struct('error', 'capacity is not positive'))
            ELSE to_json(named_struct('efficiency_pct', {percent}, 'status',
                CASE WHEN {percent} >= {tools.GOOD_PERCENT} THEN 'good'
                     WHEN {percent} >= {tools.DEGRADED_PERCENT} THEN 'degraded'
                     WHEN {percent} IS NOT NULL THEN 'critical' END)) END""",
        "wind_power(speed DOUBLE, diameter DOUBLE) RETURNS STRING "
        "COMMENT 'Theoretical output in kW from wind speed and rotor diameter, as JSON'": f"""
            to_json(named_struct(
                'power_kw', round(0.5D * {tools.AIR_DENSITY}D * pi() * pow(diameter / 2, 2D)
                                  * pow(speed, 3D) / 1000, 2),
                'meets_minimum', 0.5D * {tools.AIR_DENSITY}D * pi() * pow(diameter / 2, 2D)
                                  * pow(speed, 3D) / 1000 >= {tools.MINIMUM_KW}))""",
        "convert_units(amount DOUBLE, source STRING, target STRING) RETURNS STRING "
        "COMMENT 'Amount in another unit, as JSON'": f"""
            CASE WHEN (CASE {branches} END) IS NULL THEN
                to_json(named_struct('error',
                    concat('unsupported conversion: ', source, ' to ', target)))
            ELSE to_json(named_struct('value', CASE {branches} END,
                    'conversion', concat(source, ' to ', target))) END""",
        "maintenance_urgency(days DOUBLE, anomalies INT) RETURNS STRING "
        "COMMENT 'How urgent service is, with advice, as JSON'": f"""
            to_json(named_struct('urgency', {level}, 'action', CASE {level}
                WHEN 'urgent' THEN 'schedule service now'
                WHEN 'monitor' THEN 'watch and plan service' ELSE 'no action' END))""",
        "bin_floor(x DOUBLE, width DOUBLE) RETURNS DOUBLE "
        "COMMENT 'Lower edge of the fixed-width bin'": "CAST(floor(x / width) * width AS DOUBLE)",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in bodies]
