"""Splits, encoders, training and evaluation on Spark's own learners."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.functions.columns import time_features
from telemetra.operators import boosting
from telemetra.operators.ordering import global_row_number, running_total
from telemetra.session import materialize

LABEL = "abnormal_channel"
TEXT_FEATURES = ("location", "model", "country")
NUMBER_FEATURES = (
    "avg_energy", "std_energy", "std_channel_k",
    "ts_hour", "ts_dayofweek", "ts_month", "ts_is_weekend", "ts_quarter",
)

# Learner settings and search space.
BOOSTING = {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.1, "subsample": 0.8}
SEED = 42
SEARCH_SPACE = {
    "n_estimators": [50, 100, 150, 200],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "subsample": [0.6, 0.8, 1.0],
}


def with_time_features(df: DataFrame, time: str = "bucket") -> DataFrame:
    return df.withColumns(time_features(time))


def temporal_split(
    df: DataFrame, order: Sequence[str], train_share: float = 0.8
) -> DataFrame:
    """Mark the earliest rows as train and the rest as test.

    ``order`` starts with the time and ends in a unique key. The cut lies exactly at
    ``int(rows * share)``. Rows are counted per time, running sums of the counts tell the time
    at which the cut falls, and only rows of that time are put in order and numbered; a null
    time comes first, as in any ascending order. The rows are stored once and read back.
    """
    time = order[0]
    stored = materialize(df, "split-rows")
    counts = stored.groupBy(F.col(time).alias("_time")).agg(F.count(F.lit(1)).alias("_n"))
    reached = materialize(running_total(counts, [], ["_time"], "_n", "_earlier"), "times")
    total = reached.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    cut = int(total * train_share)
    edge = reached.where((F.col("_earlier") <= cut) & (F.col("_earlier") + F.col("_n") > cut)).first()
    if edge is None:  # no rows, or all of them train
        return stored.withColumn("split", F.lit("train"))
    at = F.lit(edge["_time"]).cast(stored.schema[time].dataType)
    inside = F.col(time).eqNullSafe(at)
    early = F.coalesce(F.col(time) < at, F.col(time).isNull())
    outside = stored.where(~inside).withColumn("split", F.when(early, "train").otherwise("test"))
    numbered = global_row_number(stored.where(inside), [F.col(c) for c in order], "_position")
    first = F.col("_position") + edge["_earlier"] <= cut
    edges = numbered.withColumn("split", F.when(first, "train").otherwise("test")).drop("_position")
    return outside.unionByName(edges)


def fit_ordinals(train: DataFrame, columns: Sequence[str] = TEXT_FEATURES) -> StringIndexerModel:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_code" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(train)


def encode_ordinals(model: StringIndexerModel, df: DataFrame) -> DataFrame:
    """Alphabetical codes of the training values; anything else becomes -1."""
    coded = model.transform(df)
    fixes = {
        out: F.when(F.col(out) < len(labels), F.col(out)).otherwise(F.lit(-1.0))
        for out, labels in zip(model.getOutputCols(), model.labelsArray)
    }
    return coded.withColumns(fixes)


def _learned(train: DataFrame, learner) -> PipelineModel:
    """Encode, assemble, learn and name the predicted class.

    The codes pass through SQL, which also drops their category metadata: the trees split on
    them as numbers, however many values a text column has.
    """
    labels = StringIndexer(
        inputCol=LABEL, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(train)
    texts = fit_ordinals(train)
    codes = [
        f"CASE WHEN {out} < {len(values)} THEN {out} ELSE -1D END AS {out}_plain"
        for out, values in zip(texts.getOutputCols(), texts.labelsArray)
    ]
    plain = SQLTransformer(statement=f"SELECT *, {', '.join(codes)} FROM __THIS__")
    features = VectorAssembler(
        inputCols=[*NUMBER_FEATURES, *[f"{c}_code_plain" for c in TEXT_FEATURES]],
        outputCol="features", handleInvalid="keep",
    )
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(labels.labels))
    return Pipeline(stages=[labels, texts, plain, features, learner, names]).fit(train)


def trial_of(params: Mapping[str, float]) -> boosting.Trial:
    return boosting.Trial(
        int(params["n_estimators"]), int(params["max_depth"]),
        float(params["learning_rate"]), float(params["subsample"]))


def train_boosted(
    train: DataFrame, params: Mapping[str, float] = BOOSTING
) -> boosting.BoostedModel:
    """Gradient-boosted trees for all classes together."""
    return boosting.fit(train, NUMBER_FEATURES, TEXT_FEATURES, LABEL, [trial_of(params)])[0]


def train_forest(train: DataFrame, trees: int = 100) -> PipelineModel:
    """Random forest on rows whose missing numbers are read as zero."""
    filled = train.fillna(0, subset=list(NUMBER_FEATURES))
    return _learned(filled, RandomForestClassifier(numTrees=trees, seed=SEED))


Model = PipelineModel | boosting.BoostedModel


def store_model(model: Model, path: str, spark: SparkSession | None = None) -> None:
    if isinstance(model, boosting.BoostedModel):
        model.store(spark or SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_boosted(spark: SparkSession, path: str) -> boosting.BoostedModel:
    return boosting.BoostedModel.load(spark, path)


def model_inputs(model: Model) -> list[str]:
    """Columns a stored model needs, read from its own stages."""
    if isinstance(model, boosting.BoostedModel):
        return model.binning.features
    needed: list[str] = []
    made: set[str] = set()
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isDefined("inputCols"):
            needed += [c for c in stage.getInputCols()]
            made |= {f"{out}_plain" for out in stage.getOutputCols()}
        if isinstance(stage, VectorAssembler):
            needed += [c for c in stage.getInputCols() if c not in made]
    return needed


def score_with(model: Model, features: DataFrame, name: str = "prediction") -> DataFrame:
    """The given columns plus the predicted class; only the model's inputs are read for it."""
    keep = [c for c in features.columns if c != name]
    return model.transform(features).select(*keep, F.col("predicted").alias(name))


# --- evaluation -------------------------------------------------------------------------


def score_metrics(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy and support-weighted F1 from the confusion counts."""
    return cell_metrics(scored.groupBy(F.col(label).alias("truth"), F.col(predicted).alias("guess")).agg(
        F.count(F.lit(1)).alias("n")))


def cell_metrics(cells: DataFrame, *by: str) -> DataFrame:
    """Accuracy and support-weighted F1 of counts ``truth, guess, n``, for each value of ``by``."""
    # one row per class: as truth, as prediction, as both
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(none)
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("c"), F.col("n").alias("truth"),
                         none.alias("guess"), hit.alias("hit")),
                F.struct(F.col("guess").alias("c"), none.alias("truth"),
                         F.col("n").alias("guess"), none.alias("hit")),
            )
        ).alias("s"),
    ).select(*by, "s.*")
    per_class = sides.groupBy(*by, "c").agg(
        F.sum("truth").alias("truth"), F.sum("guess").alias("guess"), F.sum("hit").alias("hit")
    )
    f1 = 2 * F.col("hit") / F.nullif(F.col("truth") + F.col("guess"), F.lit(0))
    return per_class.groupBy(*by).agg(
        F.sum("truth").alias("row_count"),
        (F.sum("hit") / F.sum("truth")).alias("accuracy"),
        (F.sum(f1 * F.col("truth")) / F.sum("truth")).alias("weighted_f1"),
    )


def auc_one_vs_rest(scored: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """Area under the curve per class and its support, exact with ties.

    ``scores`` maps a class to its score column. Rows are first counted per class and
    distinct score; the running count of negatives is then summed across range slices, so no
    class is sorted in a single task.
    """
    long = scored.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("class"),
                        F.col(column).cast("double").alias("score"),
                        (F.col(label) == name).cast("bigint").alias("hit"),
                    )
                    for name, column in scores.items()
                ]
            )
        ).alias("r")
    ).select("r.*")
    ties = long.groupBy("class", "score").agg(
        F.sum("hit").alias("positives"), F.sum(1 - F.col("hit")).alias("negatives")
    )
    ranked = running_total(ties, ["class"], ["score"], "negatives", "below")
    wins = F.col("positives") * (F.col("below") + F.col("negatives") / 2)
    return (
        ranked.groupBy("class")
        .agg(
            F.sum(wins).alias("_wins"),
            F.sum("positives").alias("support"),
            F.sum("negatives").alias("_negatives"),
        )
        .select(
            "class", "support",
            F.try_divide("_wins", F.col("support") * F.col("_negatives")).alias("auc"),
        )
    )


def weighted_auc(per_class: DataFrame) -> DataFrame:
    return per_class.where(F.col("auc").isNotNull()).agg(
        (F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("weighted_auc")
    )


def search_trials(
    space: Mapping[str, Sequence[float]] = SEARCH_SPACE, count: int = 10, seed: int = SEED
) -> list[dict[str, float]]:
    """The settings of the whole grid whose digests come first: a repeatable random choice."""
    def digest(setting: dict[str, float]) -> str:
        return hashlib.md5(f"{seed} {sorted(setting.items())}".encode()).hexdigest()

    settings: list[dict[str, float]] = [{}]
    for name, values in space.items():
        settings = [{**setting, name: value} for setting in settings for value in values]
    return sorted(settings, key=digest)[:count]


def param_search(
    train: DataFrame, test: DataFrame, trials: Sequence[Mapping[str, float]]
) -> DataFrame:
    """Fit every setting on the same histograms; one row of settings and metrics per trial."""
    models = boosting.fit(train, NUMBER_FEATURES, TEXT_FEATURES, LABEL, [*map(trial_of, trials)])
    metrics = cell_metrics(boosting.confusion(test, models, LABEL), "trial")
    settings = train.sparkSession.createDataFrame(
        [(number, int(t["n_estimators"]), int(t["max_depth"]), float(t["learning_rate"]),
          float(t["subsample"])) for number, t in enumerate(trials, 1)],
        "trial int, n_estimators int, max_depth int, learning_rate double, subsample double")
    return settings.join(metrics.drop("row_count"), "trial", "left")


def model_metrics(model: boosting.BoostedModel, test: DataFrame) -> DataFrame:
    """Row count, accuracy, weighted F1 and weighted one-vs-rest AUC of a model, in one row.

    The scored rows are stored, as the metrics read them twice.
    """
    scored = materialize(model.transform(test).select(LABEL, "probabilities", "predicted"), "scored")
    columns = {c: f"_p{i}" for i, c in enumerate(model.binning.classes)}
    opened = scored.select(LABEL, *[
        F.col("probabilities")[i].alias(column) for i, column in enumerate(columns.values())])
    auc = weighted_auc(auc_one_vs_rest(opened, LABEL, columns))
    both = score_metrics(scored, LABEL, "predicted").unionByName(auc, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def leaderboard(trials: DataFrame, metric: str) -> DataFrame:
    return trials.orderBy(F.col(metric).desc(), "trial")
