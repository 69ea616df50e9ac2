"""Random-forest forecast of daily inflow and outflow from calendar features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import day_features, day_key, future_days, parse_day
from ..session import ensure_checkpoint_dir
from .forests import apply_forests, grow_forests

# The features and the forest's parameters (100 trees of depth 10, seed 42).
FEATURES = ["day_of_year", "month", "day_of_week"]
TARGETS = {"total_purchase_amt": "purchase", "total_redeem_amt": "redeem"}


def with_day_features(
    series: DataFrame, *, day: str = "report_date", features: Sequence[str] = FEATURES
) -> DataFrame:
    """Add the calendar features and the assembled ``features`` vector; a day that is no date fails."""
    date = F.col(day)
    if isinstance(series.schema[day].dataType, T.StringType):
        date = parse_day(date)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(series.withColumns(day_features(date)))


def training_series(
    daily: DataFrame,
    targets: Iterable[str],
    *,
    day: str = "report_date",
    partitions: int = 2,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Features and targets of each day, computed once and checkpointed.

    The checkpoint keeps the many small training jobs from reading the balance table
    again.  Days are hashed to a fixed number of partitions and sorted there: forests
    draw their samples per partition, so a fixed layout makes them reproducible.
    """
    ensure_checkpoint_dir(daily.sparkSession)
    series = with_day_features(daily, day=day, features=features).select(
        day, "features", *[F.col(target).cast("double").alias(target) for target in targets]
    )
    return series.repartition(partitions, day).sortWithinPartitions(day).checkpoint()


def fit_forecasters(
    training: DataFrame,
    *,
    targets: dict[str, str] = TARGETS,
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    bootstrap: bool = True,
    feature_subset: str = "auto",
) -> PipelineModel:
    """One forest per target, chained so that one pass over a frame fills all predictions.

    ``targets`` maps a column of ``training`` to the name of its prediction.
    """

    @inheritable_thread_target(training.sparkSession)
    def fit(target: str) -> RandomForestRegressionModel:
        forest = RandomForestRegressor(
            labelCol=target,
            predictionCol=targets[target],
            numTrees=num_trees,
            maxDepth=max_depth,
            seed=seed,
            bootstrap=bootstrap,
            featureSubsetStrategy=feature_subset,
        )
        return forest.fit(training)

    # The fits are independent and made of short jobs: let them share the cluster.
    pool = ThreadPool(len(targets))
    try:
        return PipelineModel(pool.map(fit, list(targets)))
    finally:
        pool.close()


def future_features(
    daily: DataFrame, *, start: str | None, horizon: int, day: str, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Features of the ``horizon`` days from ``start``, or of those after the last day of the series."""
    if start is not None:
        first = F.lit(f"{start[:4]}-{start[4:6]}-{start[6:]}").cast("date")
        anchor = daily.sparkSession.range(1)
        return with_day_features(future_days(anchor, first, horizon), features=features)
    date = F.col(day)
    if isinstance(daily.schema[day].dataType, T.StringType):
        date = parse_day(date)
    anchor = daily.agg(F.max(date).alias("__last"))
    return with_day_features(future_days(anchor, F.date_add("__last", 1), horizon), features=features)


def forecast_flow(
    daily: DataFrame,
    *,
    start: str | None = None,
    horizon: int = 30,
    day: str = "report_date",
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    features: Sequence[str] = FEATURES,
    bootstrap: bool = True,
    feature_subset: str = "auto",
    forest: str = "mllib",
) -> DataFrame:
    """``report_date`` (``yyyyMMdd``), ``purchase`` and ``redeem`` for the next days, as whole numbers.

    Trees cannot extrapolate: days beyond the training range differ only by weekday.  ``forest`` says who grows
    them: ``mllib``, or ``hashed``, the forests of ``operators.forests``, which depend on seed and data alone.
    """
    if forest not in ("mllib", "hashed"):
        raise ValueError(f"unknown forest {forest!r}")
    training = training_series(daily, TARGETS, day=day, features=features)
    if forest == "hashed":
        ahead = future_features(training, start=start, horizon=horizon, day=day, features=features)
        series = with_day_features(training.drop("features"), day=day, features=features)
        nodes = grow_forests(
            series,
            TARGETS,
            key=day,
            features=features,
            num_trees=num_trees,
            max_depth=max_depth,
            seed=seed,
            bootstrap=bootstrap,
            feature_subset=feature_subset,
        )
        scored = apply_forests(nodes, ahead, TARGETS, key="report_date", features=features, num_trees=num_trees, max_depth=max_depth)
        return _forecast(scored)
    models = fit_forecasters(
        training,
        num_trees=num_trees,
        max_depth=max_depth,
        seed=seed,
        bootstrap=bootstrap,
        feature_subset=feature_subset,
    )
    ahead = future_features(training, start=start, horizon=horizon, day=day, features=features)
    return _forecast(models.transform(ahead))


def _forecast(scored: DataFrame) -> DataFrame:
    return scored.select(
        day_key(F.col("report_date")).alias("report_date"),
        F.col("purchase").cast("bigint").alias("purchase"),
        F.col("redeem").cast("bigint").alias("redeem"),
    )
