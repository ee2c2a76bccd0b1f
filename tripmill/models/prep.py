"""Feature preparation as a Spark ML stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.functions.numeric import finite
from tripmill.operators.quantiles import mode, quantiles

MISSING = "missing"
MOST_CATEGORIES = 1_000


def _quoted(name: str) -> str:
    return f"`{name}`"


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def scaling(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column divides by one. A row counts ``weight`` times."""
    if weight is not None:
        mean = df.agg(*[(F.sum(F.col(c) * F.col(weight)) / F.sum(weight)).alias(c) for c in columns]).first()
        miss = {c: F.col(c) - F.lit(mean[c]) for c in columns}
        spread = df.agg(*[F.sqrt(F.sum(m * m * F.col(weight)) / F.sum(weight)).alias(c) for c, m in miss.items()]).first()
        return {c: (mean[c] or 0.0, spread[c] or 1.0) for c in columns}
    parts = [f for c in columns for f in (F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"))]
    row = df.agg(*parts).first()
    return {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 1.0) for c in columns}


def scale_columns(df: DataFrame, scales: dict[str, tuple[float, float]], suffix: str = "_z") -> DataFrame:
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation) for c, (mean, deviation) in scales.items()}
    )


def scaling_stage(scales: dict[str, tuple[float, float]], suffix: str = "_z") -> SQLTransformer:
    """The same scaling as a stage that is saved with its model."""
    parts = [
        f"(CAST({_quoted(c)} AS DOUBLE) - {_number(mean)}) / {_number(deviation)} AS {_quoted(c + suffix)}"
        for c, (mean, deviation) in scales.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def numeric_fill(df: DataFrame, columns: Sequence[str], strategy: str = "median", weight: str | None = None) -> dict[str, float]:
    if not columns:
        return {}
    if weight is not None:
        # Rows with weights are few: Spark's own median may hold their values.
        known = {c: finite(F.col(c).cast("double")) if strategy == "median" else F.col(c).cast("double") for c in columns}
        middle = {c: F.percentile(v, F.lit(0.5), F.col(weight)) for c, v in known.items()}
        mean = {c: F.sum(v * F.col(weight)) / F.sum(F.when(v.isNotNull(), F.col(weight))) for c, v in known.items()}
        row = df.agg(*[(mean if strategy == "mean" else middle)[c].alias(c) for c in columns]).first()
        return {c: row[c] if row[c] is not None else 0.0 for c in columns}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
        return {c: row[c] if row[c] is not None else 0.0 for c in columns}
    middles = quantiles(df, {c: [0.5] for c in columns})
    return {c: middles[c][0] if middles[c][0] is not None else 0.0 for c in columns}


def text_fill(df: DataFrame, columns: Sequence[str], strategy: str = "constant", weight: str | None = None) -> dict[str, str]:
    if strategy == "constant":
        return dict.fromkeys(columns, MISSING)
    found = {c: mode(df, c, weight) for c in columns}
    return {c: MISSING if value is None else _as_text(value) for c, value in found.items()}


def _as_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


class TripFeatures(Estimator):
    """Fills, scales and encodes trip columns into one feature vector.

    Numbers: gaps filled by median or mean, then scaled with the population
    deviation. Categories: gaps filled by a constant or the most frequent value,
    then one-hot with the categories in alphabetical order; a category not seen in
    training is all zeros. Everything is learnt from the rows given to ``fit``, and
    the fitted stage consists of built-in transformers, so it is saved with the model.
    """

    def __init__(
        self,
        categorical: Sequence[str],
        numeric: Sequence[str],
        output: str = "features",
        numeric_strategy: str = "median",
        categorical_strategy: str = "constant",
        weight: str | None = None,
    ):
        super().__init__()
        self.categorical = list(categorical)
        self.numeric = list(numeric)
        self.output = output
        self.numeric_strategy = numeric_strategy
        self.categorical_strategy = categorical_strategy
        self.weight = weight

    def _fit(self, df: DataFrame) -> PipelineModel:
        prefix = f"{self.output}__"
        fills = numeric_fill(df, self.numeric, self.numeric_strategy, self.weight)
        names = text_fill(df, self.categorical, self.categorical_strategy, self.weight)
        filled = df.select(
            *[F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c) for c in self.numeric],
            *([] if self.weight is None else [self.weight]),
        )
        scales = scaling(filled, self.numeric, self.weight) if self.numeric else {}
        parts = []
        for c, (mean, deviation) in scales.items():
            value = f"COALESCE(CAST({_quoted(c)} AS DOUBLE), {_number(fills[c])})"
            parts.append(f"({value} - {_number(mean)}) / {_number(deviation)} AS {_quoted(prefix + c)}")
        for c in self.categorical:
            text = names[c].replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"COALESCE(CAST({_quoted(c)} AS STRING), '{text}') AS {_quoted(prefix + c)}")
        columns = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
        stages: list = [columns]
        inputs = [prefix + c for c in self.numeric]
        if self.categorical:
            sources = [prefix + c for c in self.categorical]
            indexes = [f"{name}__index" for name in sources]
            vectors = [f"{name}__onehot" for name in sources]
            prepared = columns.transform(df)
            _bounded(prepared, sources, prefix)
            indexer = StringIndexer(
                inputCols=sources, outputCols=indexes, handleInvalid="keep", stringOrderType="alphabetAsc"
            ).fit(prepared)
            encoder = OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True)
            stages += [indexer, encoder.fit(indexer.transform(prepared))]
            inputs += vectors
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.output))
        return PipelineModel(stages)


def _bounded(df: DataFrame, columns: Sequence[str], prefix: str) -> None:
    """Encoding gathers every distinct text of a column on the driver, so a column of keys is an error and not a category."""
    found = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    many = [f"{c.removeprefix(prefix)} (about {found[c]})" for c in columns if found[c] > MOST_CATEGORIES]
    if many:
        raise ValueError(f"over {MOST_CATEGORIES} different values, no categories: {', '.join(many)}")


def slot_names(features: PipelineModel) -> list[str]:
    """Name of every slot of the fitted feature vector, in order."""
    assembler = features.stages[-1]
    prefix = f"{assembler.getOutputCol()}__"
    labels = {}
    for stage in features.stages:
        if isinstance(stage, StringIndexerModel):
            labels = dict(zip(stage.getInputCols(), stage.labelsArray, strict=True))
    names = []
    for source in assembler.getInputCols():
        base = source.removesuffix("__onehot")
        shown = base.removeprefix(prefix)
        names += [f"{shown}={value}" for value in labels[base]] if base in labels else [shown]
    return names


def feature_lists(columns: Sequence[str], leak_safe: bool = True) -> tuple[list[str], list[str]]:
    """Categorical and numeric training columns that exist; fare give-aways left out by default."""
    banned = set(schema.TARGET_LEAKS) if leak_safe else {schema.TARGET}
    categorical = [c for c in schema.present(columns, schema.CATEGORICAL_FEATURES) if c not in banned]
    numeric = [c for c in schema.present(columns, schema.NUMERIC_FEATURES) if c not in banned]
    return categorical, numeric


def label_indexer(df: DataFrame, column: str, output: str = "label") -> StringIndexerModel:
    """Label numbers in alphabetical order."""
    indexer = StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="skip")
    return indexer.fit(df)
