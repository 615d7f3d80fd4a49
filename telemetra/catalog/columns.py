"""Projections, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from telemetra.catalog.registry import query, rounded, sql
from telemetra.functions import columns, registered, tools
from telemetra.operators import sampling, stats
from telemetra.plans import gold
from telemetra.sources import roles

TODAY = dt.date(2024, 1, 31)
NOW = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)


@query(
    "project_rename",
    sql("SELECT asset_id AS id, lat AS latitude, lon AS longitude, model FROM assets", "assets"),
)
def project_rename(spark, folder):
    return (
        roles.assets(spark, folder).select("asset_id", "lat", "lon", "model")
        .withColumnsRenamed({"asset_id": "id", "lat": "latitude", "lon": "longitude"})
    )


@query(
    "project_except",
    sql("SELECT * EXCLUDE (lat, lon, site_id) FROM assets", "assets"),
)
def project_except(spark, folder):
    return roles.assets(spark, folder).drop("lat", "lon", "site_id")


@query(
    "filter_eq",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
    "WHERE l_returnflag = 'R' AND l_linestatus <> 'O'",
)
def filter_eq(spark, folder):
    return (
        roles.table(spark, folder, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "O"))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query(
    "filter_in",
    "SELECT o_orderkey, o_orderpriority FROM orders "
    "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_in(spark, folder):
    return (
        roles.table(spark, folder, "orders")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .select("o_orderkey", "o_orderpriority")
    )


@query(
    "const_columns",
    sql(
        "SELECT asset_id, 'standard' AS grade, CAST(NULL AS VARCHAR) AS technician_notes, "
        "1.5 :: DOUBLE AS weight FROM assets",
        "assets",
    ),
)
def const_columns(spark, folder):
    return roles.assets(spark, folder).select(
        "asset_id",
        F.lit("standard").alias("grade"),
        F.lit(None).cast("string").alias("technician_notes"),
        F.lit(1.5).alias("weight"),
    )


@query(
    "drop_nulls",
    sql("SELECT ean, part_id, stock_available FROM parts WHERE ean IS NOT NULL", "parts"),
)
def drop_nulls(spark, folder):
    return roles.parts(spark, folder).select("ean", "part_id", "stock_available").dropna()


@query("sample_rows")
def sample_rows(spark, folder):
    return sampling.sample_rows(roles.telemetry(spark, folder), 0.1)


@query(
    "sample_hash",
    "SELECT event_id, value AS energy FROM ("
    "SELECT event_id, value, ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15))::BIGINT AS slot "
    "FROM events) WHERE CAST(slot AS DOUBLE) < CAST(0.1 AS DOUBLE) * 1152921504606846976",
)
def sample_hash(spark, folder):
    return sampling.sample_by_hash(roles.telemetry(spark, folder), ["event_id"], 0.1).select(
        "event_id", "energy"
    )


@query("shuffle_rows", sql("SELECT * FROM assets", "assets"))
def shuffle_rows(spark, folder):
    return sampling.shuffle_rows(roles.assets(spark, folder))


@query(
    "random_columns",
    "SELECT DISTINCT channel, true AS in_range, true AS fair_share, true AS centred, true AS varied "
    "FROM events, (VALUES ('channel_b'), ('channel_d'), ('channel_f')) c(channel)",
)
def random_columns(spark, folder):
    """Random number and random choice per reading, repeatable by seed.

    Per channel: draws lie in [0, 1), share of readings and mean draw within five deviations
    of what fair draws give, and nearly all draws differ.
    """
    channels = ("channel_b", "channel_d", "channel_f")
    drawn = roles.telemetry(spark, folder).select(
        F.rand(42).alias("draw"), columns.random_choice(channels, 43).alias("channel")
    )
    seen = drawn.groupBy("channel").agg(
        F.count("draw").alias("n"), F.avg("draw").alias("mean"), F.min("draw").alias("low"),
        F.max("draw").alias("high"), F.approx_count_distinct("draw").alias("values"),
    )
    # three rows, so one window over them is no bottleneck
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return seen.select(
        "channel",
        ((F.col("low") >= 0) & (F.col("high") < 1)).alias("in_range"),
        (F.abs(F.col("n") - total / 3) <= 5 * F.sqrt(total * 2 / 9)).alias("fair_share"),
        (F.abs(F.col("mean") - 0.5) <= 5 / F.sqrt(12 * F.col("n"))).alias("centred"),
        (F.col("values") > 0.8 * F.col("n")).alias("varied"),
    )


@query(
    "add_if_missing",
    sql("SELECT asset_id, model, 'unknown' AS report FROM assets", "assets"),
)
def add_if_missing(spark, folder):
    df = roles.assets(spark, folder).select("asset_id", "model")
    df = columns.add_if_missing(df, "report", F.lit("unknown"))
    return columns.add_if_missing(df, "model", F.lit("never used"))


@query(
    "pandas_api_features",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, "
        "round(std_energy, 6) AS std_energy FROM daily "
        "WHERE avg_energy IS NOT NULL AND std_energy IS NOT NULL",
        "daily",
    ),
)
def pandas_api_features(spark, folder):
    """The feature selection in pandas style; the frame stays distributed."""
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    frame = daily.pandas_api()[["asset_id", "bucket", "avg_energy", "std_energy"]].dropna()
    return rounded(frame.drop_duplicates(subset=["asset_id", "bucket"]).to_spark())


# --- scalar functions -------------------------------------------------------------------


@query(
    "epoch_hour",
    sql(
        "SELECT event_id, epoch_s, date_trunc('hour', to_timestamp(epoch_s) AT TIME ZONE 'UTC') "
        "AS hourly_timestamp FROM telemetry",
        "telemetry",
    ),
)
def epoch_hour(spark, folder):
    return roles.telemetry(spark, folder).select(
        "event_id", "epoch_s", columns.epoch_hour("epoch_s").alias("hourly_timestamp")
    )


@query(
    "time_features",
    "SELECT event_id, CAST(hour(ts) AS INTEGER) AS ts_hour, "
    "CAST(isodow(ts) - 1 AS INTEGER) AS ts_dayofweek, CAST(month(ts) AS INTEGER) AS ts_month, "
    "CAST(isodow(ts) >= 6 AS INTEGER) AS ts_is_weekend, CAST(quarter(ts) AS INTEGER) AS ts_quarter "
    "FROM events",
)
def time_features(spark, folder):
    return (
        roles.telemetry(spark, folder).select("event_id", "event_time")
        .withColumns(columns.time_features("event_time")).drop("event_time")
    )


@query(
    "coords_numeric",
    sql(
        "SELECT asset_id, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon FROM assets",
        "assets",
    ),
)
def coords_numeric(spark, folder):
    return columns.numeric_coordinates(roles.assets(spark, folder)).select("asset_id", "lat", "lon")


@query(
    "cast_int",
    sql(
        "SELECT asset_id, CAST(trunc(1700000000 - CAST(lon AS DOUBLE) * 80.7) AS INTEGER) AS start_time "
        "FROM assets WHERE lon <> 'ERROR'",
        "assets",
    ),
)
def cast_int(spark, folder):
    """Double to int, cut towards zero."""
    return (
        roles.assets(spark, folder).where(F.col("lon") != "ERROR")
        .select(
            "asset_id",
            (F.lit(1700000000) - F.col("lon").cast("double") * 80.7).cast("int").alias("start_time"),
        )
    )


def _murmur_steps(word: str, state: str) -> tuple[str, str]:
    """One 32-bit word into the running hash, as two SQL expressions over unsigned numbers."""
    def turned(x: str, by: int) -> str:
        return f"((({x} << {by}) | ({x} >> {32 - by})) & 4294967295::UBIGINT)"

    first = f"(({word} * 3432918353::UBIGINT) & 4294967295::UBIGINT)"
    mixed = f"(({turned(first, 15)} * 461845907::UBIGINT) & 4294967295::UBIGINT)"
    return mixed, f"((({turned(f'xor({state}, m)', 13)}) * 5 + 3864292196::UBIGINT) & 4294967295::UBIGINT)"


_LOW, _NEXT = _murmur_steps("low", "42::UBIGINT")
_HIGH, _LAST = _murmur_steps("high", "h")
_TIMES = "SELECT asset_id, (xor(h, h >> {}) * {}::UBIGINT) & 4294967295::UBIGINT AS h FROM {}"


@query(
    "severity_hash",
    sql(
        "SELECT asset_id, CAST(abs(CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 "
        "ELSE CAST(h AS BIGINT) END) % 100 AS DOUBLE) / 100 AS severity_score "
        "FROM (SELECT asset_id, xor(h, h >> 16) AS h FROM f2)",
        "assets",
        w="SELECT asset_id, CAST(asset_id & 4294967295 AS UBIGINT) AS low, "
          "CAST((asset_id >> 32) & 4294967295 AS UBIGINT) AS high FROM assets",
        m1=f"SELECT *, {_LOW} AS m FROM w",
        h1=f"SELECT asset_id, high, {_NEXT} AS h FROM m1",
        m2=f"SELECT *, {_HIGH} AS m FROM h1",
        h2=f"SELECT asset_id, xor({_LAST}, 8::UBIGINT) AS h FROM m2",
        f1=_TIMES.format(16, 2246822507, "h2"),
        f2=_TIMES.format(13, 3266489909, "f1"),
    ),
)
def severity_hash(spark, folder):
    return roles.assets(spark, folder).select(
        "asset_id", columns.severity_hash("asset_id").alias("severity_score")
    )


@query(
    "severity_md5",
    sql(
        "SELECT asset_id, CAST(('0x' || substr(md5(CAST(asset_id AS VARCHAR)), 1, 4))::INT % 100 "
        "AS DOUBLE) / 100 AS severity_score FROM assets",
        "assets",
    ),
)
def severity_md5(spark, folder):
    return roles.assets(spark, folder).select(
        "asset_id", columns.severity_md5("asset_id").alias("severity_score")
    )


@query(
    "composite_key",
    sql(
        """
        SELECT part_id, ean || '-' || stock_location AS strict_key,
               concat_ws('-', ean, stock_location) AS loose_key FROM parts""",
        "parts",
    ),
)
def composite_key(spark, folder):
    """Null parts make the strict key null and are left out of the loose one."""
    parts = [F.col("ean"), F.col("stock_location").cast("string")]
    return roles.parts(spark, folder).select(
        "part_id",
        F.concat(parts[0], F.lit("-"), parts[1]).alias("strict_key"),
        F.concat_ws("-", *parts).alias("loose_key"),
    )


@query(
    "array_item",
    sql(
        "SELECT part_id, split_part(label, '-', 1) AS first_item, split_part(label, '-', 2) AS "
        "second_item FROM (SELECT p_partkey AS part_id, p_name || '-' || p_brand AS label FROM part)",
    ),
)
def array_item(spark, folder):
    pair = F.array("p_name", "p_brand")
    return roles.table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"),
        pair.getItem(0).alias("first_item"),
        pair.getItem(1).alias("second_item"),
    )


@query(
    "struct_roundtrip",
    sql("SELECT asset_id, model, location AS place, country FROM assets", "assets"),
)
def struct_roundtrip(spark, folder):
    """Columns packed by name, then expanded again."""
    return (
        roles.assets(spark, folder)
        .selectExpr(
            "asset_id",
            "named_struct('model', model, 'place', location) AS s",
            "struct(country) AS t",
        )
        .select("asset_id", "s.*", "t.*")
    )


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field(spark, folder):
    return roles.table(spark, folder, "events").selectExpr(
        "event_id", "parse_json(props):k::bigint AS k"
    )


@query(
    "damaged_flag",
    sql("SELECT asset_id, abnormal_channel, abnormal_channel <> 'ok' AS damaged FROM status_intervals",
        "status_intervals"),
)
def damaged_flag(spark, folder):
    return roles.status_intervals(spark, folder).select(
        "asset_id", "abnormal_channel", columns.is_damaged("abnormal_channel").alias("damaged")
    )


@query(
    "min_max",
    "SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, "
    "min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice "
    "FROM lineitem",
)
def min_max(spark, folder):
    return stats.min_max(roles.table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])


# --- operator tools ---------------------------------------------------------------------


@query(
    "power_efficiency",
    """
    SELECT event_id, pct AS efficiency_pct,
           CASE WHEN pct >= 80 THEN 'good' WHEN pct >= 50 THEN 'degraded'
                WHEN pct IS NOT NULL THEN 'critical' END AS status,
           CASE WHEN k <= 0 THEN 'capacity is not positive' END AS error
    FROM (SELECT event_id, k, CASE WHEN k > 0 THEN CAST(round(CAST(CAST(value / k * 100 AS VARCHAR)
                             AS DECIMAL(38, 18)), 2) AS DOUBLE) END AS pct
          FROM (SELECT event_id, value,
                       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))""",
)
def power_efficiency(spark, folder):
    """Energy against the auxiliary channel as capacity; halves in the printed value round up."""
    result = tools.power_efficiency(F.col("energy"), F.col("channel_k"))
    return roles.telemetry(spark, folder).select("event_id", result.alias("answer")).select(
        "event_id",
        F.get_json_object("answer", "$.efficiency_pct").cast("double").alias("efficiency_pct"),
        F.get_json_object("answer", "$.status").alias("status"),
        F.get_json_object("answer", "$.error").alias("error"),
    )


@query(
    "wind_power",
    """
    SELECT l_orderkey, l_linenumber, round(kw, 4) AS power_kw, kw >= 1000 AS meets_minimum
    FROM (SELECT l_orderkey, l_linenumber,
                 0.5::DOUBLE * 1.225::DOUBLE * pi() * (l_quantity / 2) * (l_quantity / 2)
                 * power((l_discount * 100), 3) / 1000 AS kw FROM lineitem)""",
)
def wind_power(spark, folder):
    """Discount read as wind speed, quantity as rotor diameter."""
    power = tools.wind_power_kw(F.col("l_discount") * 100, F.col("l_quantity"))
    return roles.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(power, 4).alias("power_kw"),
        (power >= tools.MINIMUM_KW).alias("meets_minimum"),
    )


@query(
    "unit_convert",
    sql(
        """
        SELECT event_id, source, target, round(CASE
            WHEN source = 'mph' AND target = 'm/s' THEN energy * 0.44704::DOUBLE
            WHEN source = 'm/s' AND target = 'mph' THEN energy / 0.44704::DOUBLE
            WHEN source = 'fahrenheit' AND target = 'celsius' THEN (energy - 32) * 5 / 9
            WHEN source = 'celsius' AND target = 'fahrenheit' THEN energy * 9 / 5 + 32
            WHEN source = 'rpm' AND target = 'rad_per_sec' THEN energy * pi() / 30
            END, 4) AS converted FROM pairs""",
        "telemetry",
        pairs="""
        SELECT event_id, energy,
               CASE event_type WHEN 'click' THEN 'mph' WHEN 'view' THEN 'm/s'
                    WHEN 'error' THEN 'fahrenheit' WHEN 'signup' THEN 'celsius' ELSE 'rpm' END AS source,
               CASE event_type WHEN 'click' THEN 'm/s' WHEN 'view' THEN 'mph'
                    WHEN 'error' THEN 'celsius' WHEN 'signup' THEN 'mph' ELSE 'rad_per_sec' END AS target
        FROM telemetry""",
    ),
)
def unit_convert(spark, folder):
    """One unit pair per kind of reading; signups ask for an unsupported one."""
    kind = F.col("event_type")
    source = (
        F.when(kind == "click", "mph").when(kind == "view", "m/s")
        .when(kind == "error", "fahrenheit").when(kind == "signup", "celsius").otherwise("rpm")
    )
    target = (
        F.when(kind == "click", "m/s").when(kind == "view", "mph")
        .when(kind == "error", "celsius").when(kind == "signup", "mph").otherwise("rad_per_sec")
    )
    return (
        roles.telemetry(spark, folder)
        .select("event_id", "energy", source.alias("source"), target.alias("target"))
        .select(
            "event_id", "source", "target",
            F.round(tools.convert_units(F.col("energy"), F.col("source"), F.col("target")), 4)
            .alias("converted"),
        )
    )


@query(
    "maintenance_urgency",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN late AND noisy THEN 'urgent'
           WHEN late OR noisy THEN 'monitor' ELSE 'ok' END AS urgency
    FROM (SELECT l_orderkey, l_linenumber, l_quantity * 4 > 90 AS late,
                 l_linenumber > 3 AS noisy FROM lineitem)""",
)
def maintenance_urgency(spark, folder):
    """Quantity stands for days since service, line number for anomalies."""
    answer = tools.maintenance_urgency(F.col("l_quantity") * 4, F.col("l_linenumber"))
    return roles.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.get_json_object(answer, "$.urgency").alias("urgency")
    )


# --- functions callable from SQL --------------------------------------------------------

_DAILY_SCORES = sql(
    "SELECT asset_id, bucket, CASE WHEN std_energy > 60 THEN 'channel_b' "
    "WHEN avg_energy < 25 THEN 'channel_d' WHEN avg_energy > 120 THEN 'channel_f' ELSE 'ok' END "
    "AS prediction FROM daily",
    "daily",
)


@query("rule_score_udf", _DAILY_SCORES)
def rule_score_udf(spark, folder):
    score = registered.register_rule_udf(spark, "telemetra_predict")
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    return daily.select("asset_id", "bucket", score(*score.inputs).alias("prediction"))


@query("sql_fn_score", _DAILY_SCORES)
def sql_fn_score(spark, folder):
    name = registered.register_rule_sql(spark, "telemetra_fault_of")
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    return daily.selectExpr(
        "asset_id", "bucket", f"{name}(avg_energy, std_energy) AS prediction"
    )


@query(
    "sql_tools",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount = 0 THEN NULL WHEN round(l_tax / l_discount * 100, 2) >= 80 THEN 'good'
                WHEN round(l_tax / l_discount * 100, 2) >= 50 THEN 'degraded' ELSE 'critical' END AS efficiency,
           CASE WHEN l_quantity * 4 > 90 AND l_linenumber > 3 THEN 'urgent'
                WHEN l_quantity * 4 > 90 OR l_linenumber > 3 THEN 'monitor' ELSE 'ok' END AS urgency,
           round(l_quantity * 0.44704::DOUBLE, 4) AS metres_per_second,
           round(0.5::DOUBLE * 1.225::DOUBLE * pi() * 1600 * power(l_quantity, 3) / 1000, 2) AS power_kw,
           floor(l_extendedprice / 1000) * 1000 AS price_bin
    FROM lineitem""",
)
def sql_tools(spark, folder):
    """The operator tools called by name from SQL text."""
    registered.register_tools(spark)
    roles.table(spark, folder, "lineitem").createOrReplaceTempView("telemetra_tool_lines")
    return spark.sql(
        """
        SELECT l_orderkey, l_linenumber,
               get_json_object(power_efficiency(l_tax, l_discount), '$.status') AS efficiency,
               get_json_object(maintenance_urgency(l_quantity * 4, l_linenumber), '$.urgency') AS urgency,
               round(cast(get_json_object(convert_units(l_quantity, 'mph', 'm/s'), '$.value')
                          AS double), 4) AS metres_per_second,
               round(cast(get_json_object(wind_power(l_quantity, 80D), '$.power_kw') AS double), 2)
                   AS power_kw,
               bin_floor(l_extendedprice, 1000D) AS price_bin
        FROM telemetra_tool_lines"""
    )


@query(
    "asset_spec_fn",
    sql(
        "SELECT DISTINCT t.asset_id, a.model, a.location FROM telemetry t "
        "LEFT JOIN assets a USING (asset_id)",
        "telemetry", "assets",
    ),
)
def asset_spec_fn(spark, folder):
    """Struct from a table for every asset that sent readings, known or not."""
    specs = roles.assets(spark, folder).select("asset_id", "model", "location")
    name = registered.register_spec_lookup(spark, specs, "telemetra_asset_spec")
    seen = roles.telemetry(spark, folder).select("asset_id").distinct()
    return seen.selectExpr("asset_id", f"{name}(asset_id) AS spec").select(
        "asset_id", "spec.model", "spec.location"
    )


@query(
    "readings_tf",
    sql(
        "SELECT event_id, event_time, energy FROM telemetry WHERE asset_id = 7",
        "telemetry",
    ),
)
def readings_tf(spark, folder):
    name = registered.register_readings_of(spark, roles.telemetry(spark, folder), "telemetra_readings_of")
    return spark.sql(f"SELECT * FROM {name}(7)")


@query(
    "map_blocks",
    sql(
        "SELECT event_id, asset_id, round(energy * 0.5 + channel_k, 6) AS blended FROM telemetry",
        "telemetry",
    ),
)
def map_blocks(spark, folder):
    """Frame-wise Python over Arrow batches."""

    def blend(frames):
        for frame in frames:
            frame["blended"] = (frame["energy"] * 0.5 + frame["channel_k"]).round(6)
            yield frame[["event_id", "asset_id", "blended"]]

    readings = roles.telemetry(spark, folder).select("event_id", "asset_id", "energy", "channel_k")
    return readings.mapInPandas(blend, "event_id bigint, asset_id bigint, blended double")
