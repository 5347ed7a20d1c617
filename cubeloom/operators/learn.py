"""Random forests (Spark MLlib) and curve fitting."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import CubeBase


def _strategy(max_variables, n: int) -> str:
    if max_variables is None:
        return str(max(1, math.ceil(n / 3)))
    if max_variables in ("all", "onethird", "sqrt", "log2"):
        return max_variables
    return str(int(max_variables))


class RandomForest:
    """A trained forest with the names of its predictors."""

    def __init__(self, model: PipelineModel, predictors: list[str]):
        self.model, self.predictors = model, predictors

    def save(self, path: str) -> str:
        self.model.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str) -> "RandomForest":
        model = PipelineModel.load(path)
        assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
        return cls(model, list(assembler.getInputCols()))


def _fit(df: DataFrame, predictors: list[str], target: str, estimator, label: str, before=()) -> RandomForest:
    clean = df.select(*predictors, target).dropna()
    assembler = VectorAssembler(inputCols=predictors, outputCol="features", handleInvalid="keep")
    model = Pipeline(stages=[*before, assembler, estimator.setLabelCol(label).setFeaturesCol("features")]).fit(clean)
    return RandomForest(model, predictors)


def fit_class_random_forest(df: DataFrame, predictors: list[str], target: str, max_variables=None, num_trees: int = 100,
                            seed: int | None = None) -> RandomForest:
    forest = RandomForestClassifier(numTrees=num_trees, featureSubsetStrategy=_strategy(max_variables, len(predictors)),
                                    **({"seed": seed} if seed is not None else {}))
    index = StringIndexer(inputCol=target, outputCol="__label", stringOrderType="alphabetAsc")
    fitted = _fit(df, predictors, target, forest, "__label", before=[index])
    # prediction needs no label: keep assembler and forest, and the class names as metadata
    labels = fitted.model.stages[0].labels
    from pyspark.ml.feature import IndexToString

    back = IndexToString(inputCol="prediction", outputCol="predicted_class", labels=labels)
    return RandomForest(PipelineModel([*fitted.model.stages[1:], back]), predictors)


def fit_regr_random_forest(df: DataFrame, predictors: list[str], target: str, max_variables=None, num_trees: int = 100,
                           seed: int | None = None) -> RandomForest:
    forest = RandomForestRegressor(numTrees=num_trees, featureSubsetStrategy=_strategy(max_variables, len(predictors)),
                                   **({"seed": seed} if seed is not None else {}))
    return _fit(df, predictors, target, forest, target)


class LearnOps(CubeBase):
    def predict_random_forest(self, model: RandomForest):
        """Predict per cell along the bands; null where a predictor is null."""
        for p in model.predictors:
            self.schema.find_bands(p)
        out = model.model.transform(self.df.withColumns({p: F.col(p).cast("double") for p in model.predictors}))
        label = F.col("predicted_class").cast("double") if "predicted_class" in out.columns else F.col("prediction")
        some = F.lit(True)
        for p in model.predictors:
            some = some & F.col(p).isNotNull()
        return self._new(out.withColumn("value", F.when(some, label)), self.schema.single())

    # -- curves ----------------------------------------------------------------------

    def fit_curve(self, parameters: list[float], function, dimension: str, unit: float = 1.0, ignore_nodata: bool = True):
        """Least-squares parameters of ``function(x, parameters)`` per series and band.

        Every round is one aggregate: the squares and the normal equations of all series at
        their trial parameters, starting from the given values. A trial that does not raise
        the squares is taken and the damping falls, else it is undone and the damping rises
        (Levenberg and Marquardt); the small systems are scaled and solved in batches. It
        ends when no series moves any more; the table of series is written between rounds,
        so no round repeats those before. A singular system, a series without enough values
        and, unless ``ignore_nodata``, one with nulls give nulls. ``x`` is the numeric label
        divided by ``unit`` (seconds for time). The result has the bands ``<band>_p0 ...``.
        """
        schema = self.schema
        keys = schema.others(dimension)
        n = len(parameters)
        if n == 0:
            raise ValueError("at least one parameter is needed")
        # every round reads the series, so they are written once
        df = cut_lineage(self.df.withColumn("__x", numeric_label(self.df, dimension) / unit).select(*keys, "__x", *schema.values))
        start = F.array(*[F.lit(float(p)) for p in parameters])
        trials = {v: start for v in schema.values}
        state: DataFrame | None = None
        while True:
            rows = df if state is None else df.join(state.select(*keys, *[f"__try_{v}" for v in schema.values]), keys)
            aggs = []
            for v in schema.values:
                p = [F.get(trials[v], F.lit(i)) for i in range(n)]
                base = function(F.col("__x"), p)
                step = [F.greatest(F.abs(q), F.lit(1.0)) * SLOPE_STEP for q in p]
                slopes = [(function(F.col("__x"), [q + h if i == k else q for i, q in enumerate(p)])
                           - function(F.col("__x"), [q - h if i == k else q for i, q in enumerate(p)])) / (2 * h) for k, h in enumerate(step)]
                rest = F.col(v).cast("double") - base
                some = F.col(v).isNotNull()
                sums = [F.sum(F.when(some, slopes[i] * slopes[j])) for i in range(n) for j in range(i, n)]
                sums += [F.sum(F.when(some, slopes[i] * rest)) for i in range(n)]
                aggs.append(F.array(*sums, F.sum(F.when(some, rest * rest)), F.count_if(~some).cast("double")).alias(f"__s_{v}"))
            found = rows.groupBy(*keys).agg(*aggs)
            before = start_state(found.select(*keys), schema.values, parameters) if state is None else state
            state = cut_lineage(found.join(before, keys).mapInPandas(
                moves(schema.values, n, ignore_nodata), before.schema))
            trials = {v: F.col(f"__try_{v}") for v in schema.values}
            moving = F.lit(False)
            for v in schema.values:
                moving = moving | F.col(f"__open_{v}")
            if state.where(moving).isEmpty():
                break
        names = [f"{v}_p{i}" for v in schema.values for i in range(n)]
        fitted = state.select(*keys, *[F.get(F.col(f"__best_{v}"), F.lit(i)).alias(f"{v}_p{i}") for v in schema.values for i in range(n)])
        return self._new(fitted, schema.without(dimension).with_bands(names, schema.band_dim or "bands"))

    def predict_curve(self, parameters, function, dimension: str, labels: list | None = None, unit: float = 1.0):
        """The model at given labels, or in place of nulls only when no labels are given."""
        from ..functions import dates

        schema = self.schema
        keys = schema.others(dimension)
        n = len(parameters.schema.values) // len(schema.values)
        fitted = parameters.df
        if labels is not None:
            temporal = schema.dim(dimension).type == "temporal"
            marks = F.array(*[dates.ntz(dates.parse(l)) if temporal else F.lit(l) for l in labels])
            df = fitted.withColumn(dimension, F.explode(marks))
        else:
            df = self.df.join(fitted, keys, "left")
        df = df.withColumn("__x", numeric_label(df, dimension) / unit)
        model = {v: function(F.col("__x"), [F.col(f"{v}_p{i}") for i in range(n)]) for v in schema.values}
        if labels is None:
            model = {v: F.coalesce(F.col(v).cast("double"), m) for v, m in model.items()}
        return self._new(df.withColumns(model))


def numeric_label(df: DataFrame, dimension: str) -> Column:
    from pyspark.sql import types as T

    from ..plans.scan import order_key

    dtype = df.schema[dimension].dataType
    key = order_key(df, dimension)
    return key / 1e6 if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else key.cast("double")


SLOPE_STEP = 1e-4  # relative step of the central differences
SETTLED = 1e-9  # relative move of the parameters below which a series is done
STIFFEST = 1e12  # damping at which no smaller step is tried


def start_state(keys: DataFrame, bands: list[str], parameters: list[float]) -> DataFrame:
    """The state of all series before the first round."""
    first = F.array(*[F.lit(float(p)) for p in parameters])
    none = F.lit(None).cast("array<double>")
    return keys.withColumns({name: c for v in bands for name, c in (
        (f"__try_{v}", first), (f"__best_{v}", none), (f"__sums_{v}", none), (f"__damp_{v}", F.lit(1e-7)), (f"__open_{v}", F.lit(True)))})


def moves(bands: list[str], n: int, ignore_nodata: bool):
    """One step of all series of a batch: take or undo the trial, then solve for the next."""
    import numpy as np

    upper = np.triu_indices(n)

    def of_band(frame: pd.DataFrame, v: str) -> None:
        sums = np.stack(frame[f"__s_{v}"].map(lambda r: np.array([np.nan if x is None else x for x in r], float)))
        trial = np.stack(frame[f"__try_{v}"].map(np.asarray)).astype(float)
        known = frame[f"__best_{v}"].notna().to_numpy()
        best = np.where(known[:, None], np.stack([b if k else t for b, k, t in zip(frame[f"__best_{v}"], known, trial)]), trial).astype(float)
        old = np.stack([np.asarray(o, float) if k else s for o, k, s in zip(frame[f"__sums_{v}"], known, sums)])
        damp, opened = frame[f"__damp_{v}"].to_numpy(float), frame[f"__open_{v}"].to_numpy(bool)
        better = opened & np.isfinite(sums).all(axis=1) & (~known | ~(sums[:, -2] > old[:, -2]))
        now = np.where(better[:, None], sums, old)
        place = np.where(better[:, None], trial, best)
        damp = np.where(~opened, damp, np.where(better, damp / 10, damp * 10))
        normal = np.zeros((len(frame), n, n))
        normal[:, upper[0], upper[1]] = now[:, : len(upper[0])]
        normal[:, upper[1], upper[0]] = now[:, : len(upper[0])]
        right = now[:, len(upper[0]) : len(upper[0]) + n]
        usable = np.isfinite(now).all(axis=1)
        size = np.sqrt(np.where(usable[:, None], np.einsum("kii->ki", normal), 1.0))
        usable &= (size > 0).all(axis=1)
        size = np.where(size > 0, size, 1.0)
        scaled = np.where(usable[:, None, None], normal / size[:, :, None] / size[:, None, :], np.eye(n))
        usable &= np.linalg.matrix_rank(scaled, tol=1e-11, hermitian=True) == n
        if not ignore_nodata:
            usable &= now[:, -1] == 0
        scaled = np.where(usable[:, None, None], scaled, np.eye(n))
        pull = np.where(usable[:, None], right / size, 0.0)[:, :, None]
        step = np.linalg.solve(scaled + damp[:, None, None] * np.eye(n), pull)[:, :, 0] / size
        small = (np.abs(step) <= SETTLED * (np.abs(place) + SETTLED)).all(axis=1)
        # squares that only change in their last digits have reached their floor
        level = known & (np.abs(sums[:, -2] - old[:, -2]) <= 1e-12 * np.abs(old[:, -2]))
        last = opened & usable & (small | level)  # the small rest is taken without damping
        place = np.where(last[:, None], place + np.linalg.solve(scaled, pull)[:, :, 0] / size, place)
        opened &= usable & ~small & ~level & (damp < STIFFEST)
        frame[f"__best_{v}"] = [p.tolist() if u else None for p, u in zip(place, usable)]
        frame[f"__sums_{v}"] = now.tolist()
        frame[f"__try_{v}"] = np.where(opened[:, None], place + step, place).tolist()
        frame[f"__damp_{v}"], frame[f"__open_{v}"] = damp, opened

    def moved(frames):
        for frame in frames:
            if len(frame):
                for v in bands:
                    of_band(frame, v)
                yield frame.drop(columns=[f"__s_{v}" for v in bands])

    return moved
