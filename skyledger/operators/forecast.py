"""Forecasting with Spark ML: labels ahead, time features, chronological split, boosted trees, metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import calendar
from skyledger.operators import segments
from skyledger.sources import files

#: The features of the forecast.
FEATURES = ("pm25", "pm10", "o3", "no2", "so2", "co", "aod", "dust", "uv_index", "hour_sin", "hour_cos", "dow_sin", "dow_cos")


def lead_label(df: DataFrame, column: str, ahead: int, clock: bool = False) -> DataFrame:
    """``label``: the value ``ahead`` rows later in the location, or with ``clock`` that many hours later; null where there is none."""
    if not clock:
        return segments.with_lead(df, column, ahead, "label")
    later = df.select("location_key", (F.col("ts_utc") - F.expr(f"interval {int(ahead)} hours")).alias("ts_utc"), F.col(column).alias("label"))
    return df.join(later, ["location_key", "ts_utc"], "left")


def sample_to_size(df: DataFrame, size: int, seed: int = 42) -> DataFrame:
    n = df.count()
    return df if n <= size else df.sample(size / n, seed=seed)


#: Parts into which a range of hashes is cut at a time, and hashes that reach the driver at the end.
_CUTS = 4096


def block_hash(seed: int, unit: str) -> Column:
    """Below 2**60; rows of one location and one ``unit`` of time have one hash."""
    block = F.concat_ws("#", F.lit(str(seed)), F.coalesce("location_key", F.lit("")), F.coalesce(F.date_format(F.date_trunc(unit, "ts_utc"), "yyyy-MM-dd HH"), F.lit("")))
    return F.conv(F.substring(F.md5(block), 1, 15), 16, 10).cast("long")


def sample_blocks(df: DataFrame, size: int, seed: int = 42, unit: str = "week") -> DataFrame:
    """About ``size`` rows: whole blocks of a location and a ``unit`` of time, so that series stay series.

    Blocks are taken in the order of a hash of ``seed``, location and time, up to that number of them, one at least, whose
    rows come nearest to ``size``: half a block off at most. Where all rows are fewer all are taken. The hash to stop at is found from sums
    over _CUTS parts of the range that is left; no list of blocks reaches the driver but the last part's.
    """
    h = block_hash(seed, unit)
    blocks = files.kept(df.groupBy(h.alias("h")).agg(F.count("*").alias("n")), "blocks")
    low, bits, before = 0, 60, 0
    while bits:
        inside = blocks.filter((F.col("h") >= low) & (F.col("h") < low + (1 << bits)))
        few = [tuple(r) for r in inside.orderBy("h").limit(_CUTS + 1).collect()]
        if len(few) <= _CUTS:
            break
        bits -= 12
        parts = inside.groupBy(F.shiftright(F.col("h") - low, bits).alias("part")).agg(F.sum("n").alias("n"))
        for part, n in sorted(tuple(r) for r in parts.collect()):  # _CUTS rows
            if before + n >= size:
                break
            before += n
        else:
            return df
        low += part << bits
    at, stop = before, low - 1
    for nth, n in few:
        if at + n - size > size - at and at:
            break
        at, stop = at + n, nth
    return df.filter(h <= stop)


def as_timestamp(df: DataFrame, column: str = "ts_utc") -> DataFrame:
    """``column`` as a timestamp, whatever it was."""
    return df if dict(df.dtypes)[column] == "timestamp" else df.withColumn(column, F.to_timestamp(column))


def supervised(df: DataFrame, ahead: int = 6, column: str = "pm25", min_rows: int = 0, sample: int = 0, seed: int = 42) -> DataFrame:
    """Rows with every base feature and a label, with time features; about ``sample`` of them, if set, in whole location weeks
    taken once labels are known."""
    df = as_timestamp(df)
    base = [f for f in FEATURES if f in df.columns]
    rows = lead_label(df.dropna(subset=[column]), column, ahead).dropna(subset=[*base, "label"])
    if min_rows and rows.limit(min_rows).count() < min_rows:
        raise ValueError(f"fewer than {min_rows} rows to learn from")
    rows = sample_blocks(rows, sample, seed) if sample else rows
    return rows.withColumns(calendar.cyclic(F.col("ts_utc")))


def chronological_split(df: DataFrame, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    ranked = with_rank(df)
    return ranked.filter(F.col("rank_pct") <= ratio).drop("rank_pct"), ranked.filter(F.col("rank_pct") > ratio).drop("rank_pct")


def with_rank(df: DataFrame) -> DataFrame:
    return segments.with_percent_rank(df, "rank_pct")


def fit(train: DataFrame, seed: int = 42, grid: dict | None = None, parallelism: int = 2) -> PipelineModel:
    """Assembler, scaler, boosted trees; ``grid`` (parameter name to values) tunes on a held-out part."""
    trees = GBTRegressor(labelCol="label", featuresCol="scaled", seed=seed, maxIter=10, maxDepth=4)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip")
    pipeline = Pipeline(stages=[assembler, StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True), trees])
    if not grid:
        return pipeline.fit(train)
    maps = ParamGridBuilder()
    for name, values in grid.items():
        maps = maps.addGrid(trees.getParam(name), values)
    search = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=maps.build(), evaluator=RegressionEvaluator(labelCol="label"), trainRatio=0.85, seed=seed, parallelism=parallelism)
    return search.fit(train).bestModel


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    pairs = zip(FEATURES, model.stages[-1].featureImportances.toArray(), strict=True)
    return sorted(((f, round(float(x), 6)) for f, x in pairs), key=lambda p: (-p[1], p[0]))


def metrics(predictions: DataFrame, *by: str, least_label: float = 0.0) -> DataFrame:
    """rmse, mae, r2, mape (percent, over labels that are not 0) in one pass, rounded to 6 places; with ``least_label`` mape
    divides by no less than that, and takes all labels."""
    e, y = F.col("label") - F.col("prediction"), F.col("label")
    spread = F.var_pop(y) * F.count(y)
    size = F.greatest(F.abs(y), F.lit(least_label)) if least_label else F.when(y != 0, F.abs(y))
    found = {"rmse": F.sqrt(F.avg(e * e)), "mae": F.avg(F.abs(e)), "r2": 1 - F.sum(e * e) / F.nullif(spread, F.lit(0.0)), "mape": F.avg(F.abs(e) / size) * 100}
    return predictions.groupBy(*by).agg(F.count("*").alias("n"), *[F.round(v, 6).alias(k) for k, v in found.items()])


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", F.col("prediction") - F.col("label"))


def series(predictions: DataFrame) -> DataFrame:
    """What was and what was predicted, of each location in order of time where it is written."""
    return predictions.select("location_key", "ts_utc", F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
