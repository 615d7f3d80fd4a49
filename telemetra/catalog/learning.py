"""Feature tables, splits, encoders, learners and metrics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from telemetra.catalog.registry import query, rounded, sql
from telemetra.functions.columns import rule_score
from telemetra.operators import boosting
from telemetra.operators.sampling import random_split as split_rows
from telemetra.plans import gold, learning
from telemetra.session import scratch_path
from telemetra.sources import roles


def features_of(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    training = gold.training_set(
        daily, roles.assets(spark, folder), roles.status_intervals(spark, folder)
    )
    return gold.feature_table(training)


def split_features(spark, folder):
    timed = learning.with_time_features(features_of(spark, folder))
    return learning.temporal_split(timed, ["bucket", "asset_id"])


_SPLIT = """
    SELECT *, CASE WHEN row_number() OVER (ORDER BY bucket, asset_id)
              <= CAST(floor((SELECT count(*) FROM features) * 0.8) AS BIGINT)
              THEN 'train' ELSE 'test' END AS split FROM features"""


@query(
    "feature_table",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, round(std_energy, 6) AS "
        "std_energy, round(std_channel_k, 6) AS std_channel_k, location, model, country, "
        "abnormal_channel FROM features",
        "features",
    ),
)
def feature_table(spark, folder):
    return rounded(features_of(spark, folder))


@query(
    "temporal_split",
    sql("SELECT asset_id, bucket, split FROM parted", "features", parted=_SPLIT),
)
def temporal_split(spark, folder):
    return split_features(spark, folder).select("asset_id", "bucket", "split")


def _code(column: str) -> str:
    return (
        f"CAST(coalesce((SELECT count(DISTINCT t.{column}) FROM train t WHERE t.{column} < p.{column} "
        f"AND p.{column} IN (SELECT {column} FROM train)) + CASE WHEN p.{column} IN "
        f"(SELECT {column} FROM train) THEN 0 ELSE -1 END, -1) AS DOUBLE) AS {column}_code"
    )


@query(
    "ordinal_encode",
    sql(
        f"SELECT asset_id, bucket, {_code('location')}, {_code('model')}, {_code('country')} "
        "FROM features p",
        "features",
        train="SELECT * FROM features WHERE country <> 'EUROPE' AND model <> 'small'",
    ),
)
def ordinal_encode(spark, folder):
    """Codes learned without one region and one model, so both are unknown later."""
    features = features_of(spark, folder)
    known = features.where((F.col("country") != "EUROPE") & (F.col("model") != "small"))
    model = learning.fit_ordinals(known)
    return learning.encode_ordinals(model, features).select(
        "asset_id", "bucket", *[f"{c}_code" for c in learning.TEXT_FEATURES]
    )


@query(
    "random_split",
    sql("SELECT asset_id, bucket, CAST(1 AS BIGINT) AS times_drawn FROM features", "features"),
)
def random_split(spark, folder):
    """Every row falls into exactly one of the three parts."""
    parts = split_rows(features_of(spark, folder), [0.7, 0.2, 0.1])
    named = [p.withColumn("split", F.lit(n)) for p, n in zip(parts, ("train", "val", "test"))]
    together = named[0].unionByName(named[1]).unionByName(named[2])
    return together.groupBy("asset_id", "bucket").agg(F.count("split").alias("times_drawn"))


@query(
    "random_split_shares",
    sql("SELECT DISTINCT split, true AS fair_share FROM features, "
        "(VALUES ('train'), ('val'), ('test')) s(split)", "features"),
)
def random_split_shares(spark, folder):
    """Each part's share of all rows lies within five deviations of its weight."""
    weights = {"train": 0.7, "val": 0.2, "test": 0.1}
    parts = split_rows(features_of(spark, folder), list(weights.values()))
    counts = [
        p.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("split"), F.lit(share).alias("share"), "n")
        for p, (name, share) in zip(parts, weights.items())
    ]
    # three rows, so one window over them is no bottleneck
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    room = 5 * F.sqrt(total * F.col("share") * (1 - F.col("share")))
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).select(
        "split", (F.abs(F.col("n") - total * F.col("share")) <= room).alias("fair_share"))


def scored_features(spark, folder):
    return features_of(spark, folder).withColumn("prediction", rule_score())


_SCORED = """
    SELECT *, CASE WHEN std_energy > 60 THEN 'channel_b' WHEN avg_energy < 25 THEN 'channel_d'
              WHEN avg_energy > 120 THEN 'channel_f' ELSE 'ok' END AS prediction FROM features"""


@query(
    "score_metrics",
    sql(
        """
        SELECT CAST(sum(truth) AS BIGINT) AS row_count,
               round(sum(hit) / sum(truth), 6) AS accuracy,
               round(sum(CASE WHEN truth + guess > 0 THEN 2 * hit / (truth + guess) * truth END)
                     / sum(truth), 6) AS weighted_f1
        FROM (SELECT c, count(*) FILTER (s.abnormal_channel = c) AS truth,
                     count(*) FILTER (s.prediction = c) AS guess,
                     count(*) FILTER (s.prediction = c AND s.abnormal_channel = c) AS hit
              FROM scored s, (SELECT DISTINCT unnest([abnormal_channel, prediction]) AS c FROM scored)
              GROUP BY c)""",
        "features", scored=_SCORED,
    ),
)
def score_metrics(spark, folder):
    scored = scored_features(spark, folder)
    return rounded(learning.score_metrics(scored, "abnormal_channel", "prediction"))


SCORES = {"channel_b": "score_b", "channel_d": "score_d", "ok": "score_ok"}

_RANKED = """
    SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY score)
           + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS midrank
    FROM (SELECT 'channel_b' AS class, abnormal_channel = 'channel_b' AS hit,
                 floor(std_energy + 0.0037) AS score FROM features
          UNION ALL SELECT 'channel_d', abnormal_channel = 'channel_d', -floor(avg_energy + 0.0037) FROM features
          UNION ALL SELECT 'ok', abnormal_channel = 'ok', floor(avg_energy + 0.0037) FROM features)"""
_AUC = """
    SELECT class, CAST(count(*) FILTER (hit) AS BIGINT) AS support,
           (sum(midrank) FILTER (hit) - count(*) FILTER (hit) * (count(*) FILTER (hit) + 1) / 2)
           / nullif(count(*) FILTER (hit) * count(*) FILTER (NOT hit), 0) AS auc
    FROM ranked GROUP BY class"""


def class_scores(spark, folder):
    """A hand-made score per class in whole units, so that ties occur.

    The small shift keeps exact integers away from the unit edge, where the last bit of a
    mean, which depends on the order of the rows, would decide.
    """
    return features_of(spark, folder).withColumns(
        {
            "score_b": F.floor(F.col("std_energy") + 0.0037),
            "score_d": -F.floor(F.col("avg_energy") + 0.0037),
            "score_ok": F.floor(F.col("avg_energy") + 0.0037),
        }
    )


@query(
    "auc_ovr",
    sql(
        "SELECT class, support, round(auc, 6) AS auc FROM aucs",
        "features", ranked=_RANKED, aucs=_AUC,
    ),
)
def auc_ovr(spark, folder):
    per_class = learning.auc_one_vs_rest(class_scores(spark, folder), "abnormal_channel", SCORES)
    return rounded(per_class)


@query(
    "auc_weighted",
    sql(
        "SELECT round(sum(auc * support) / sum(support), 6) AS weighted_auc FROM aucs "
        "WHERE auc IS NOT NULL",
        "features", ranked=_RANKED, aucs=_AUC,
    ),
)
def auc_weighted(spark, folder):
    per_class = learning.auc_one_vs_rest(class_scores(spark, folder), "abnormal_channel", SCORES)
    return rounded(learning.weighted_auc(per_class))


def parted(spark, folder):
    """Train and test rows; the split is already stored, so both read it back."""
    rows = split_features(spark, folder)
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


@query("train_gbt")
def train_gbt(spark, folder):
    train, test = parted(spark, folder)
    scored = learning.train_boosted(train).transform(test)
    return scored.groupBy("abnormal_channel", "predicted").agg(F.count(F.lit(1)).alias("row_count"))


@query("model_score")
def model_score(spark, folder):
    """A trained forest, stored and loaded again, applied to every feature row."""
    train, _ = parted(spark, folder)
    path = scratch_path(spark, "forest")
    learning.store_model(learning.train_forest(train), path)
    timed = learning.with_time_features(features_of(spark, folder))
    return learning.score_with(learning.load_model(path), timed).select(
        "asset_id", "bucket", "prediction"
    )


_FIRST_SPLITS = """
    SELECT abnormal_channel AS class, unnest([
             {'i': 0, 'f': 'avg_energy', 'x': avg_energy}, {'i': 1, 'f': 'std_energy', 'x': std_energy},
             {'i': 2, 'f': 'std_channel_k', 'x': std_channel_k},
             {'i': 3, 'f': 'ts_hour', 'x': CAST(hour(bucket) AS DOUBLE)},
             {'i': 4, 'f': 'ts_dayofweek', 'x': CAST(isodow(bucket) - 1 AS DOUBLE)},
             {'i': 5, 'f': 'ts_month', 'x': CAST(month(bucket) AS DOUBLE)},
             {'i': 6, 'f': 'ts_is_weekend', 'x': CAST(isodow(bucket) >= 6 AS DOUBLE)},
             {'i': 7, 'f': 'ts_quarter', 'x': CAST(quarter(bucket) AS DOUBLE)},
             {'i': 8, 'f': 'location', 'x': CAST(dense_rank() OVER (ORDER BY location) - 1 AS DOUBLE)},
             {'i': 9, 'f': 'model', 'x': CAST(dense_rank() OVER (ORDER BY model) - 1 AS DOUBLE)},
             {'i': 10, 'f': 'country', 'x': CAST(dense_rank() OVER (ORDER BY country) - 1 AS DOUBLE)}]) AS v
    FROM parted WHERE split = 'train'"""
_EDGES = """
    SELECT DISTINCT i, f, unnest(q) AS edge FROM (
      SELECT v.i AS i, v.f AS f,
             quantile_disc(v.x, list_transform(range(1, 255), lambda k: k / 256.0)) AS q
      FROM long GROUP BY ALL)"""


@query(
    "gbt_first_splits",
    sql(
        """
        SELECT class, f AS feature, round(edge, 6) AS largest_left, round(gain, 6) AS gain FROM (
          SELECT class, i, f, edge, round(
              power(p * nl - yl, 2) / (p * (1 - p) * nl + 1)
              + power(p * (n - nl) - (y - yl), 2) / (p * (1 - p) * (n - nl) + 1)
              - power(p * n - y, 2) / (p * (1 - p) * n + 1), 9) AS gain
          FROM sums JOIN (SELECT class, y, n, y / n AS p FROM
              (SELECT abnormal_channel AS class, count(*) AS y FROM parted WHERE split = 'train' GROUP BY 1),
              (SELECT count(*) AS n FROM parted WHERE split = 'train')) USING (class))
        WHERE gain > 1e-9
        QUALIFY row_number() OVER (PARTITION BY class ORDER BY gain DESC, i, edge) = 1""",
        "features", parted=_SPLIT, long=_FIRST_SPLITS, edges=_EDGES,
        sums="""
        SELECT c.class, e.i, e.f, e.edge, count(*) AS nl, count(*) FILTER (l.class = c.class) AS yl
        FROM edges e JOIN long l ON l.v.i = e.i AND l.v.x <= e.edge,
             (SELECT DISTINCT class FROM long) c GROUP BY ALL""",
    ),
)
def gbt_first_splits(spark, folder):
    """The root split of each class's first tree, from one pass of histogram sums."""
    train, _ = parted(spark, folder)
    model = learning.train_boosted(train, {**learning.BOOSTING, "n_estimators": 1, "max_depth": 1, "subsample": 1.0})
    return rounded(spark.createDataFrame(
        boosting.first_splits(model), "class string, feature string, largest_left double, gain double"))


@query("model_metrics")
def model_metrics(spark, folder):
    """Accuracy, weighted F1 and weighted AUC of the fully trained boosted model."""
    train, test = parted(spark, folder)
    return learning.model_metrics(learning.train_boosted(train), test)


@query(
    "model_signature",
    sql("SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS differing FROM features", "features"),
)
def model_signature(spark, folder):
    """A stored model finds its inputs by name: shuffled and extra columns change no label."""
    train, _ = parted(spark, folder)
    path = scratch_path(spark, "boosted")
    few = {**learning.BOOSTING, "n_estimators": 20}
    learning.store_model(learning.train_boosted(train, few), path)
    model = learning.load_boosted(spark, path)
    timed = learning.with_time_features(features_of(spark, folder))
    plain = learning.score_with(model, timed.select("asset_id", "bucket", *learning.model_inputs(model)))
    turned = timed.select(
        F.lit("x").alias("predicted"), *reversed(timed.columns), F.lit(1.5).alias("probabilities"))
    other = learning.score_with(model, turned, "other").select("asset_id", "bucket", "other")
    both = plain.select("asset_id", "bucket", "prediction").join(other, ["asset_id", "bucket"])
    return both.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~F.col("prediction").eqNullSafe(F.col("other"))).alias("differing"))


@query("param_search")
def param_search(spark, folder):
    train, test = parted(spark, folder)
    return learning.param_search(train, test, learning.search_trials())


@query(
    "trial_leaderboard",
    sql(
        """
        SELECT asset_id AS trial, round(avg(CAST(abnormal_channel = prediction AS INTEGER)), 6)
               AS accuracy FROM scored GROUP BY asset_id ORDER BY accuracy DESC, trial""",
        "features", scored=_SCORED,
    ),
)
def trial_leaderboard(spark, folder):
    """Each asset's accuracy under the rule read as one trial, best first."""
    hit = (F.col("abnormal_channel") == F.col("prediction")).cast("int")
    trials = scored_features(spark, folder).groupBy(F.col("asset_id").alias("trial")).agg(
        F.round(F.avg(hit), 6).alias("accuracy")
    )
    return learning.leaderboard(trials, "accuracy")
