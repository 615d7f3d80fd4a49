"""Registration of queries and composition of their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from telemetra.sources.roles import ROLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

RULE_CASE = (
    "CASE WHEN std_energy > 60 THEN 'channel_b' WHEN avg_energy < 25 THEN 'channel_d' "
    "WHEN avg_energy > 120 THEN 'channel_f' ELSE 'ok' END"
)


def _bucketed(grain: str) -> str:
    return f"""
        SELECT asset_id, CAST(date_trunc('{grain}', event_time) AS TIMESTAMP) AS bucket,
               avg(energy) AS avg_energy, stddev_pop(energy) AS std_energy,
               stddev_pop(channel_k) AS std_channel_k
        FROM clean GROUP BY ALL"""


# Named steps of the checks: text and the steps it builds on.
STEPS: dict[str, tuple[str, tuple[str, ...]]] = {
    **{name: (text, ()) for name, text in ROLE_SQL.items()},
    "clean": ("SELECT * FROM telemetry WHERE energy IS NOT NULL AND energy > 0", ("telemetry",)),
    "hourly": (_bucketed("hour"), ("clean",)),
    "daily": (_bucketed("day"), ("clean",)),
    "latest": (
        "SELECT * FROM daily QUALIFY row_number() OVER "
        "(PARTITION BY asset_id ORDER BY bucket DESC) = 1",
        ("daily",),
    ),
    "status": (
        f"SELECT l.*, a.* EXCLUDE (asset_id), {RULE_CASE} AS prediction "
        "FROM latest l JOIN assets a USING (asset_id)",
        ("latest", "assets"),
    ),
    "queue": (
        """
        SELECT asset_id, location, prediction AS predicted_failure_type,
               CAST(('0x' || substr(md5(CAST(asset_id AS VARCHAR)), 1, 4))::INT % 100 AS DOUBLE)
                   / 100 AS severity_score,
               'Pending' AS status, TIMESTAMP '2024-01-31 12:00:00' AS flagged_at,
               CAST(NULL AS VARCHAR) AS technician_notes,
               TIMESTAMP '2024-01-31 12:00:00' AS last_updated
        FROM status WHERE prediction <> 'ok'""",
        ("status",),
    ),
    "labelled": (
        """
        SELECT d.*, a.* EXCLUDE (asset_id), s.abnormal_channel, s.start_time, s.end_time
        FROM daily d JOIN assets a USING (asset_id)
        JOIN status_intervals s ON d.asset_id = s.asset_id
             AND s.start_time < epoch(d.bucket) AND s.end_time > epoch(d.bucket)""",
        ("daily", "assets", "status_intervals"),
    ),
    "features": (
        """
        SELECT asset_id, bucket, avg_energy, std_energy, std_channel_k, location, model, country,
               abnormal_channel
        FROM labelled WHERE avg_energy IS NOT NULL AND std_energy IS NOT NULL
             AND std_channel_k IS NOT NULL AND location IS NOT NULL AND model IS NOT NULL
             AND country IS NOT NULL AND abnormal_channel IS NOT NULL""",
        ("labelled",),
    ),
}


def sql(body: str, *needs: str, **extra: str) -> str:
    """Put the named steps, in dependency order, and any extra ones in front of the body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for below in STEPS[name][1]:
            visit(below)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = [f"{name} AS ({STEPS[name][0]})" for name in ordered]
    ctes += [f"{name} AS ({text})" for name, text in extra.items()]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = " ".join(check.split("\n"))
        return run

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: sums of floats depend on the order of the rows."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
