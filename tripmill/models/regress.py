"""Fare regressors: one for all trips, or one for each fare category."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.models import forests
from tripmill.models.boosting import BoostedTrees
from tripmill.models.prep import TripFeatures, slot_names
from tripmill.operators.metrics import regression_metrics
from tripmill.operators.sampling import split
from tripmill.operators.validation import category_sizes, column_roles, split_roles
from tripmill.session import cut_lineage, spread

FEATURES = "fare_features"
PREDICTED = "predicted_fare"
SIDE = "__train"
_MEASURES = ("mae", "mse", "rmse", "r2", "mape")
#: What learns the same from cells of equal features, weighted by their rows, as from the rows.
_CELL_ARMS = (LinearRegression, RandomForestRegressor, BoostedTrees)
#: The deepest trees that Spark grows stand for trees without a limit.
DEEPEST = 30


def forest_regressor(
    trees: int = 100, depth: int = 10, min_rows: int = 1, seed: int = 42, prediction: str = PREDICTED
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=schema.TARGET,
        predictionCol=prediction,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_rows,
        seed=seed,
    )


def boosted_regressor(rounds: int = 100, depth: int = 3, rate: float = 0.1) -> BoostedTrees:
    """Gradient boosting by least squares: trees on residuals, from the mean on."""
    return BoostedTrees(FEATURES, schema.TARGET, PREDICTED, "squared", 1, rounds, depth, rate)


def second_order_regressor(rounds: int = 100, depth: int = 6, rate: float = 0.3) -> BoostedTrees:
    """Boosting by gradients and curvatures, with a penalty on leaves, as external boosting libraries do."""
    return BoostedTrees(FEATURES, schema.TARGET, PREDICTED, "squared", 2, rounds, depth, rate)


def linear_regressor() -> LinearRegression:
    return LinearRegression(featuresCol=FEATURES, labelCol=schema.TARGET, predictionCol=PREDICTED)


def default_arms(trees: int = 100, seed: int = 42) -> dict[str, Estimator]:
    """The algorithms compared, at the study's settings; a forest of unlimited depth is Spark's deepest."""
    return {
        "linear_regression": linear_regressor(),
        "random_forest": forest_regressor(trees, depth=DEEPEST, seed=seed),
        "gradient_boosting": boosted_regressor(trees, depth=3, rate=0.1),
        "second_order_boosting": second_order_regressor(trees),
    }


def regression_columns(df: DataFrame, leak_safe: bool = True) -> tuple[list[str], list[str]]:
    """Columns by their role in the data, the fare (and its give-aways) left out."""
    banned = set(schema.TARGET_LEAKS) if leak_safe else {schema.TARGET}
    roles = column_roles(df.drop(*banned), target=schema.TARGET)
    return split_roles(roles)


def _usable(df: DataFrame) -> DataFrame:
    return df.filter(F.col(schema.TARGET).isNotNull())


def feature_rows(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], categorical_strategy: str = "constant") -> tuple[PipelineModel, DataFrame]:
    """The fitted features and what an algorithm is fitted on: vectors and fares of the rows that have one."""
    train = _usable(train)
    features = TripFeatures(categorical, numeric, FEATURES, categorical_strategy=categorical_strategy).fit(train)
    return features, features.transform(train).select(FEATURES, F.col(schema.TARGET).cast("double").alias(schema.TARGET))


def fit_regressor(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    estimator: Estimator | None = None,
    categorical_strategy: str = "constant",
) -> PipelineModel:
    """Features and regressor. A forest grows on cells of equal features where they are few, else on written rows dealt to all cores."""
    estimator = estimator or forest_regressor(depth=15, min_rows=2)
    inputs = [*categorical, *numeric]
    if isinstance(estimator, RandomForestRegressor) and forests.few_cells(_usable(train), inputs):
        return fit_on_cells(cells_of(train, inputs, estimator), categorical, numeric, estimator, categorical_strategy)
    features, rows = feature_rows(train, categorical, numeric, categorical_strategy)
    if isinstance(estimator, RandomForestRegressor):
        rows = cut_lineage(spread(rows))
    return PipelineModel([features, estimator.fit(rows)])


def cells_of(rows: DataFrame, inputs: Sequence[str], estimator: RandomForestRegressor, by: Sequence[str] = ()) -> DataFrame:
    """Cells of the rows that have a fare, by groups of them, written: all that is learnt from the rows is learnt from these."""
    return cut_lineage(forests.cells(_usable(rows), inputs, schema.TARGET, estimator.getNumTrees(), estimator.getSeed(), by))


def cell_features(
    table: DataFrame, categorical: Sequence[str], numeric: Sequence[str], categorical_strategy: str = "constant", by: Sequence[str] = ()
) -> tuple[PipelineModel, DataFrame]:
    """The features that the rows of these cells give, and the cells with their vectors, held."""
    inputs = [*categorical, *numeric]
    joined = (forests.together(table, inputs, by) if by else table).coalesce(1).cache()
    features = TripFeatures(categorical, numeric, FEATURES, categorical_strategy=categorical_strategy, weight=forests.ROWS).fit(joined)
    vectors = features.transform(joined).select(FEATURES, *[c for c in joined.columns if c not in inputs]).cache()
    vectors.count()
    joined.unpersist()
    return features, vectors


def fit_on_cells(
    table: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    estimator: RandomForestRegressor,
    categorical_strategy: str = "constant",
    by: Sequence[str] = (),
) -> PipelineModel:
    """What ``fit_regressor`` gives for the rows of these cells."""
    features, vectors = cell_features(table, categorical, numeric, categorical_strategy, by)
    forest = forests.grow(estimator, vectors)
    vectors.unpersist()
    return PipelineModel([features, forest])


def predict(model: PipelineModel, df: DataFrame, output: str = PREDICTED) -> DataFrame:
    """Rows with the prediction of one model, under any name."""
    scored = model.transform(df)
    return scored.select(*[c for c in df.columns if c != output], F.col(PREDICTED).alias(output))


def score(model: PipelineModel, test: DataFrame) -> DataFrame:
    return regression_metrics(predict(model, _usable(test)), schema.TARGET, PREDICTED)


def feature_importances(model: PipelineModel, top: int | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Importance of every encoded feature, largest first."""
    features, trees = model.stages[0], model.stages[1]
    weights = [float(w) for w in trees.featureImportances.toArray()]
    rows = list(zip(slot_names(features), weights, strict=True))
    spark = spark or SparkSession.active()
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table if top is None else table.limit(top)


def fit_by_category(
    df: DataFrame,
    key: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    category: str = "fare_category",
    least: int = 10,
    trees: int = 100,
    depth: int = 10,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """A forest per category with at least ``least`` rows, and its test scores."""
    sizes = category_sizes(df, category)
    models, scores = {}, []
    for name in schema.FARE_LABELS:
        if sizes.get(name, 0) < least:
            continue
        train, test = split(df.filter(F.col(category) == name), key)
        models[name] = fit_regressor(train, categorical, numeric, forest_regressor(trees, depth))
        scores.append(score(models[name], test).withColumn("category", F.lit(name)))
    return models, _stack(scores, df.sparkSession, "category")


def _stack(scores: Sequence[DataFrame], spark: SparkSession, *first: str) -> DataFrame:
    if not scores:
        columns = [f"{name} string" for name in first] + [f"{m} double" for m in ("mae", "mse", "rmse", "r2", "mape")]
        return spark.createDataFrame([], ", ".join(columns))
    return reduce(DataFrame.unionByName, scores).select(*first, "mae", "mse", "rmse", "r2", "mape")


def select_by_category(
    df: DataFrame,
    key: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    category: str = "predicted_fare_category",
    least: int = 5,
    arms: Mapping[str, Estimator] | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Every algorithm per category; the one with the smallest absolute error is kept.

    Where different features are few, all is learnt from cells of equal features, which one scan makes for all categories,
    and one scan scores the test rows with all algorithms.
    """
    arms, spark = arms or default_arms(), df.sparkSession
    sizes = category_sizes(df, category)
    names = [name for name in schema.FARE_LABELS if sizes.get(name, 0) >= least]
    inputs = [*categorical, *numeric]
    if all(isinstance(one, _CELL_ARMS) for one in arms.values()) and forests.few_cells(_usable(df), inputs):
        best, rows = _select_on_cells(df, key, categorical, numeric, category, names, arms)
    else:
        best, rows = _select_on_rows(df, key, categorical, numeric, category, names, arms)
    measures = "mae double, mse double, rmse double, r2 double, mape double"
    return best, spark.createDataFrame(rows, f"category string, regressor string, {measures}")


def _select_on_rows(df, key, categorical, numeric, category, names, arms) -> tuple[dict[str, PipelineModel], list[tuple]]:
    best, rows = {}, []
    for name in names:
        train, test = split(df.filter(F.col(category) == name), key)
        lowest = None
        # The features are those of the category, whatever the algorithm: they are fitted and written once.
        features, vectors = feature_rows(train, categorical, numeric, "mode")
        vectors = cut_lineage(spread(vectors))
        for arm, estimator in arms.items():
            model = PipelineModel([features, estimator.fit(vectors)])
            found = score(model, test).first()
            rows.append((name, arm, *[found[m] for m in _MEASURES]))
            if lowest is None or (found["mae"] is not None and found["mae"] < lowest):
                lowest, best[name] = found["mae"], model
    return best, rows


def _select_on_cells(df, key, categorical, numeric, category, names, arms) -> tuple[dict[str, PipelineModel], list[tuple]]:
    inputs, by = [*categorical, *numeric], [category, SIDE]
    train, test = (side.filter(F.col(category).isin(names)) for side in split(df, key))
    parts = train.withColumn(SIDE, F.lit(True)).unionByName(test.withColumn(SIDE, F.lit(False)))
    most = max([one.getNumTrees() for one in arms.values() if isinstance(one, RandomForestRegressor)], default=0)
    table = cells_of(parts, inputs, forest_regressor(max(most, 1), seed=_seed(arms)), by)
    models, told = {}, []
    for name in names:
        mine = table.filter(F.col(category) == name)
        features, vectors = cell_features(mine.filter(SIDE), categorical, numeric, "mode", by)
        known = features.transform(mine.select(*inputs, category).distinct()).select(*inputs, category, FEATURES)
        for number, (arm, estimator) in enumerate(arms.items()):
            fitted = _fit_on_cells(estimator, vectors)
            models[name, arm] = PipelineModel([features, fitted])
            known = fitted.transform(known).withColumnRenamed(PREDICTED, f"p{number}")
        told.append(cut_lineage(known.drop(FEATURES)))
        vectors.unpersist()
    found = {}
    if told:
        scored = forests.with_predictions(_usable(test), reduce(DataFrame.unionByName, told), [*inputs, category])
        each = F.array(*[F.struct(F.lit(arm).alias("regressor"), F.col(f"p{number}").alias(PREDICTED)) for number, arm in enumerate(arms)])
        long = scored.select(F.col(category).alias("category"), F.col(schema.TARGET).cast("double").alias(schema.TARGET), F.inline(each))
        found = {(r["category"], r["regressor"]): r for r in regression_metrics(long, schema.TARGET, PREDICTED, "category", "regressor").collect()}
    best, rows = {}, []
    for name in names:
        lowest = None
        for arm in arms:
            row = found.get((name, arm))
            rows.append((name, arm, *[None if row is None else row[m] for m in _MEASURES]))
            mae = rows[-1][2]
            if lowest is None or (mae is not None and mae < lowest):
                lowest, best[name] = mae, models[name, arm]
    return best, rows


def _seed(arms: Mapping[str, Estimator]) -> int:
    return next((one.getSeed() for one in arms.values() if isinstance(one, RandomForestRegressor)), 42)


def _fit_on_cells(estimator: Estimator, vectors: DataFrame) -> Model:
    """What the algorithm learns from the rows of cells: squares around a cell's mean are the same for every model."""
    if isinstance(estimator, RandomForestRegressor):
        return forests.grow(estimator, vectors)
    means = vectors.select(FEATURES, (F.col(forests.TOTAL) / F.col(forests.ROWS)).alias(schema.TARGET), F.col(forests.ROWS).cast("double").alias(forests.ROWS))
    if isinstance(estimator, BoostedTrees):
        return estimator.on_cells(forests.ROWS).fit(means)
    return estimator.copy().setWeightCol(forests.ROWS).fit(means)


def dispatch(df: DataFrame, models: Mapping[str, PipelineModel], category: str = "predicted_fare_category", output: str = PREDICTED) -> DataFrame:
    """Prediction of the model of each row's category, 0.0 where there is none.

    One pass: each row meets the expression of its own category only, so neither a
    filter per category nor a union reads the rows again.
    """
    scored, choice = df, None
    for name, model in models.items():
        column = f"__fare_{name}"
        scored = predict(model, scored, column)
        test = F.col(category) == name
        choice = F.when(test, F.col(column)) if choice is None else choice.when(test, F.col(column))
    value = F.lit(0.0) if choice is None else F.coalesce(choice, F.lit(0.0))
    return scored.select(*[c for c in df.columns if c != output], value.alias(output))
