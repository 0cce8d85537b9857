"""Global regressors over all series and horizons, on Spark ML."""

from __future__ import annotations

import functools
import itertools
import random
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import TypeVar

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import floored, non_negative
from demandloom.operators.adjust import blend_search, seasonal_mean, threshold_scale_search, unbiased_scale_search
from demandloom.operators.attribution import PREFIX, linear_attribution
from demandloom.operators.baselines import apply_calibration, fit_calibration, level_factor, validation_split
from demandloom.operators.boosting import BoostedModel, Booster, Loss
from demandloom.operators.sampling import sample_fraction
from demandloom.settings import SERIES_KEYS
from demandloom.sources.tables import dropped, staged, staging_root

CATEGORIES = ("item_id", "dept_id", "cat_id", "store_id", "state_id", "target_event_type")
NOT_FEATURES = ("series_id", "origin_date", "target_date", "target", "_run_id")
MISSING = "__missing__"
#: Fits that run at the same time.
FITS_AT_ONCE = 4
Found = TypeVar("Found")
# Boosted trees by name, and the loss of each; parameters may change power, level and delta.
TREE_LOSSES = {
    "tweedie_trees": {"kind": "tweedie"},
    "poisson_trees": {"kind": "tweedie", "power": 1.0},
    "quantile_trees": {"kind": "quantile"},
    "huber_trees": {"kind": "huber"},
}


def side_by_side(calls: Sequence[Callable[[], Found]]) -> list[Found]:
    """Results of independent calls in their order, up to FITS_AT_ONCE of them under way.

    A fit is a chain of short jobs, each waiting for the one before, which leaves most cores idle; several chains share them.
    Their inputs have to be staged before.
    """
    carried = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(FITS_AT_ONCE, len(calls)))) as pool:
        return pool.map(lambda call: call(), [carried(call) for call in calls], chunksize=1)


def fit_categories(frame: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """(column_name, category, code): alphabetical codes from 0 per column.

    Distinct pairs are found with map-side combination and written in ranges of about equal numbers of values, so keys
    that share a prefix are divided as well. Values are ranked inside their range and shifted by the number of values in
    earlier ones; no task ranks a whole column. The written copy fixes the ranges for the two passes that read them.
    """
    present = [c for c in columns if c in frame.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("category"))
            for c in present
        ]
    )
    ranged = frame.select(F.inline(pairs)).distinct().repartitionByRange("column_name", "category")
    values = staged(ranged.withColumn("_slice", F.spark_partition_id()), "category-values")
    slices = values.groupBy("column_name", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("column_name").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("column_name", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("column_name", "_slice").orderBy("category")
    ranked = values.withColumn("_place", F.row_number().over(inside) - 1).join(starts, ["column_name", "_slice"])
    return ranked.select("column_name", "category", (F.col("_start") + F.col("_place")).cast("double").alias("code"))


def encode_categories(frame: DataFrame, dictionary: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """Replace categories by their codes; unseen values become -1."""
    encoded = frame
    for c in [c for c in columns if c in frame.columns]:
        codes = dictionary.where(F.col("column_name") == c).select(
            F.col("category").alias("_category"), F.col("code").alias("_code")
        )
        value = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        encoded = (
            encoded.join(codes, value == F.col("_category"), "left")
            .withColumn(c, F.coalesce("_code", F.lit(-1.0)))
            .drop("_category", "_code")
        )
    return encoded


def numeric_features(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in NOT_FEATURES]


def as_number(column: str, damped: bool = False) -> Column:
    """Number or 0: unparsable and missing values both become 0.

    ``damped`` takes the signed logarithm, which keeps log-link fits stable when
    prices and day numbers are thousands of times larger than rates.
    """
    value = F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))
    return F.signum(value) * F.log1p(F.abs(value)) if damped else value


@dataclass
class DirectForecaster:
    """One model for all series and horizons, with level factor and residual quantiles.

    ``kind`` chooses the learner; ``params`` are passed on to it. Fitted state is
    small (coefficients or trees, one factor, a calibration table).
    """

    kind: str = "tweedie"
    params: Mapping[str, object] = field(default_factory=dict)
    seed: int = 42
    features: list[str] = field(default_factory=list)
    dictionary: DataFrame | None = None
    model: Transformer | BoostedModel | None = None
    factor: float = 1.0
    calibration: DataFrame | None = None

    @property
    def linear(self) -> bool:
        return self.kind in ("tweedie", "poisson", "huber")

    @property
    def boosted(self) -> bool:
        return self.kind in TREE_LOSSES

    def _booster(self) -> Booster:
        params = {"seed": self.seed} | dict(self.params)
        shape = {k: params.pop(k) for k in ("power", "level", "delta") if k in params}
        return Booster(Loss(**(TREE_LOSSES[self.kind] | shape)), **params)

    def _learner(self):
        common = {"featuresCol": "scaled" if self.linear else "features", "labelCol": "target", "predictionCol": "_raw"}
        glm = {"linkPower": 0.0, "regParam": 0.01, "maxIter": 15}
        choices = {
            "tweedie": lambda p: GeneralizedLinearRegression(
                family="tweedie", **common, **({"variancePower": 1.2} | glm | p)
            ),
            "poisson": lambda p: GeneralizedLinearRegression(
                family="poisson", link="log", **common, **({"regParam": 0.01, "maxIter": 15} | p)
            ),
            "gbt": lambda p: GBTRegressor(
                seed=self.seed, **common, **({"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8} | p)
            ),
            "absolute": lambda p: GBTRegressor(
                lossType="absolute", seed=self.seed, **common, **({"maxIter": 20, "maxDepth": 5, "stepSize": 0.1} | p)
            ),
            "huber": lambda p: LinearRegression(loss="huber", **common, **({"regParam": 0.01, "maxIter": 30} | p)),
        }
        if self.kind not in choices:
            raise ValueError(f"unknown learner {self.kind!r}; choose from {sorted([*choices, *TREE_LOSSES])}")
        learner = choices[self.kind](dict(self.params))
        if not self.linear:
            return learner
        # penalties and steps of a linear fit mean the same for every feature only on one scale
        return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True), learner])

    def vectors(self, frame: DataFrame) -> DataFrame:
        """Keys, target and the assembled feature vector; other columns travel along."""
        encoded = encode_categories(frame.withColumns({f"_k_{c}": F.col(c) for c in SERIES_KEYS}), self.dictionary)
        ready = encoded.withColumns({f"_x_{c}": as_number(c, self.linear) for c in self.features})
        assembled = VectorAssembler(inputCols=[f"_x_{c}" for c in self.features], outputCol="features").transform(ready)
        originals = {c: F.col(f"_k_{c}") for c in SERIES_KEYS}
        return assembled.withColumns(originals).drop(
            *[f"_x_{c}" for c in self.features], *[f"_k_{c}" for c in SERIES_KEYS]
        )

    def fit_model(self, train: DataFrame) -> DirectForecaster:
        if "target" not in train.columns:
            raise ValueError("training data must contain target")
        self.features = numeric_features(train)
        if self.dictionary is None:
            self.dictionary = staged(fit_categories(train), "categories")
        # The fit reads its input once per iteration: materialise the vectors, and
        # keep what fits in memory next to the tasks while it runs.
        learner = self._booster() if self.boosted else self._learner()
        if self.boosted:
            told_apart = F.xxhash64(*[c for c in (*SERIES_KEYS, "origin_day", "horizon") if c in train.columns]).alias("row_key")
            self.model = learner.fit(self.vectors(train).select("features", "target", told_apart))
            return self
        vectors = staged(self.vectors(train).select("features", "target"), "vectors").persist()
        self.model = learner.fit(vectors)
        vectors.unpersist()
        dropped(vectors)
        return self

    def raw(self, frame: DataFrame) -> DataFrame:
        """Frame plus non-negative, unscaled forecast."""
        scored = self.model.transform(self.vectors(frame))
        kept = [c for c in frame.columns if c not in CATEGORIES or c in SERIES_KEYS]
        return scored.select(*kept, non_negative(F.col("_raw")).alias("yhat"))

    def points(self, frame: DataFrame) -> DataFrame:
        return self.raw(frame).withColumn("yhat", F.col("yhat") * F.lit(self.factor))

    def fit(self, train: DataFrame, validation: DataFrame | None = None) -> DirectForecaster:
        """Fit on ``train``; level factor and quantiles come from ``validation`` when given."""
        self.fit_model(train)
        judged = staged(self.raw(validation if validation is not None else train).select("horizon", "target", "yhat"), "judged")
        self.factor = 1.0 if validation is None else float(level_factor(judged).first()["level_factor"])
        scaled = judged.withColumn("yhat", F.col("yhat") * F.lit(self.factor))
        # (horizons + 1) rows.
        self.calibration = staged(fit_calibration(scaled, []), "calibration")
        return self

    def predict(self, frame: DataFrame) -> DataFrame:
        """Frame plus yhat, q05, q50, q95; the row keys travel with the prediction."""
        return apply_calibration(self.points(frame), self.calibration, [])

    def coefficients(self) -> tuple[dict[str, float], float]:
        """Weights by feature name and the intercept, for linear learners."""
        scaler, fitted = self.model.stages
        spread = scaler.std.toArray()
        # a constant feature is scaled to zero and has no influence
        weights = np.where(spread > 0, fitted.coefficients.toArray() / np.where(spread > 0, spread, 1.0), 0.0)
        return dict(zip(self.features, weights.tolist())), float(fitted.intercept - weights @ scaler.mean.toArray())

    def importances(self) -> dict[str, float]:
        """Share of impurity reduction by feature name, for tree learners."""
        return dict(zip(self.features, (float(v) for v in self.model.featureImportances.toArray())))

    def explain(self, frame: DataFrame) -> DataFrame:
        """Additive attribution on the learner's link scale: exact for linear learners and for boosted trees.

        Trees get path-dependent Shapley values, in the layout that the attribution reports read.
        """
        if self.boosted:
            told = self.model.explain(self.vectors(frame), self.features, PREFIX)
            seen = [F.col("features_seen")[k].alias(f"feature_{c}") for k, c in enumerate(self.features)]
            told = told.withColumn("features_seen", vector_to_array("features"))
            return told.select("series_id", "horizon", *[f"{PREFIX}{c}" for c in self.features], *seen, "base_value", "model_output")
        weights, intercept = self.coefficients()
        encoded = encode_categories(frame, self.dictionary).select(
            "series_id", *[as_number(c, self.linear).alias(c) for c in self.features]
        )
        return linear_attribution(encoded, weights, intercept)


def save_forecaster(forecaster: DirectForecaster, path: str) -> None:
    """Store everything needed to score later: pipeline, dictionary, calibration, factor."""
    spark = forecaster.dictionary.sparkSession
    if forecaster.boosted:
        forecaster.model.table(spark).write.mode("overwrite").parquet(f"{path}/model")
    else:
        PipelineModel([forecaster.model]).write().overwrite().save(f"{path}/model")
    forecaster.dictionary.write.mode("overwrite").parquet(f"{path}/categories")
    forecaster.calibration.write.mode("overwrite").parquet(f"{path}/calibration")
    facts = [(forecaster.kind, forecaster.seed, forecaster.factor, forecaster.features)]
    spark.createDataFrame(facts, "kind string, seed int, factor double, features array<string>").write.mode(
        "overwrite"
    ).parquet(f"{path}/facts")


def load_forecaster(spark, path: str) -> DirectForecaster:
    facts = spark.read.parquet(f"{path}/facts").first()
    if facts["kind"] in TREE_LOSSES:
        model = BoostedModel.of_table(spark.read.parquet(f"{path}/model"))
    else:
        model = PipelineModel.load(f"{path}/model").stages[0]
    return DirectForecaster(
        kind=facts["kind"],
        seed=facts["seed"],
        features=list(facts["features"]),
        dictionary=spark.read.parquet(f"{path}/categories"),
        model=model,
        factor=facts["factor"],
        calibration=spark.read.parquet(f"{path}/calibration"),
    )


def candidates(**choices: Sequence[object]) -> tuple[dict[str, object], ...]:
    """All combinations of the parameters' values."""
    return tuple(dict(zip(choices, values, strict=True)) for values in itertools.product(*choices.values()))


# Candidate grids of the temporal search; `search_parameters` takes any other.
SEARCH_GRID: dict[str, tuple[dict[str, object], ...]] = {
    "tweedie": candidates(regParam=(0.001, 0.01, 0.1), variancePower=(1.1, 1.3, 1.5)),
    "poisson": candidates(regParam=(0.001, 0.01, 0.1), maxIter=(15, 30)),
    "gbt": candidates(maxIter=(10, 20), maxDepth=(4, 6), stepSize=(0.05, 0.1), subsamplingRate=(0.8,)),
}


def _sampled(frame: DataFrame, keys: Sequence[str], fraction: float, seed: int, label: str) -> DataFrame:
    """Staged hash sample of the rows; an empty one is an error that a larger fraction mends."""
    sample = staged(sample_fraction(frame, keys, fraction, seed), label)
    if sample.isEmpty():
        raise ValueError(f"a fraction of {fraction} leaves no rows to tune on")
    return sample


def weighted_miss(scored: DataFrame) -> float:
    """WAPE of (target, yhat)."""
    miss = F.sum(F.abs(F.col("yhat") - F.col("target"))) / floored(F.sum(F.abs("target")))
    return float(scored.agg(miss.alias("wape")).first()["wape"])


def search_parameters(
    train: DataFrame, kind: str, fraction: float, seed: int, grid: Sequence[Mapping[str, object]] | None = None
) -> tuple[dict[str, object], DataFrame]:
    """Pick the candidate with the lowest WAPE on the newest training origin.

    Rows are sampled by key hash; the split is temporal, never random. Returns the
    winner's parameters and one result row per candidate.
    """
    keys = ["series_id", "origin_day", "horizon"]
    fit_rows, judge_rows = validation_split(train)
    fit_rows = _sampled(fit_rows, keys, fraction, seed, "search-fit")
    judge_rows = _sampled(judge_rows, keys, fraction, seed, "search-judge")
    dictionary = staged(fit_categories(fit_rows), "categories")

    def error(candidate: Mapping[str, object]) -> float:
        fitted = DirectForecaster(kind, candidate, seed, dictionary=dictionary).fit_model(fit_rows)
        return weighted_miss(fitted.points(judge_rows))

    tried = list(grid if grid is not None else SEARCH_GRID[kind])
    errors = side_by_side([functools.partial(error, candidate) for candidate in tried])
    results = [(n, dict(candidate), e) for n, (candidate, e) in enumerate(zip(tried, errors, strict=True))]
    best = min(results, key=lambda r: (r[2], r[0]))
    table = train.sparkSession.createDataFrame(
        [(kind, n, {k: str(v) for k, v in p.items()}, w, n == best[0]) for n, p, w in results],
        "kind string, candidate int, parameters map<string,string>, wape double, chosen boolean",
    )
    return best[1], table


@dataclass(frozen=True)
class Span:
    """Values that a parameter of the halving search may take."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def draw(self, share: float) -> float | int:
        """The value at a share of the span."""
        if self.log:
            value = self.low * (self.high / self.low) ** share
        else:
            value = self.low + (self.high + self.whole - self.low) * share
        return min(int(value), int(self.high)) if self.whole else value


# Spans of the halving search for boosted trees; `halving_search` takes any other.
TREE_SPACE: dict[str, Span] = {
    "rounds": Span(4, 10, whole=True),
    "step": Span(0.05, 0.4, log=True),
    "subsample": Span(0.65, 1.0),
    "colsample": Span(0.65, 1.0),
    "ridge": Span(0.1, 10.0, log=True),
    "depth": Span(3, 6, whole=True),
    "leaf_rows": Span(1, 12, whole=True),
}


def drawn_candidates(space: Mapping[str, Span], trials: int, seed: int) -> list[dict[str, float | int]]:
    """One set of parameters per trial; a trial's draw depends on the seed and its number only."""
    return [
        {name: span.draw(random.Random(f"{seed}:{n}:{name}").random()) for name, span in space.items()}
        for n in range(trials)
    ]


def rungs(trials: int, keep: int, fraction: float) -> list[tuple[int, float]]:
    """Candidates and share of the rows of every rung; the last one has a single candidate and the whole fraction."""
    if trials < 1 or keep < 2 or not 0 < fraction <= 1:
        raise ValueError("at least one trial, a factor of two or more and a fraction in (0, 1] are needed")
    counts = [trials]
    while counts[-1] > 1:
        counts.append(max(1, counts[-1] // keep))
    return [(n, fraction / keep ** (len(counts) - 1 - k)) for k, n in enumerate(counts)]


def halving_search(
    train: DataFrame, kind: str, trials: int, seed: int, fraction: float = 1.0, keep: int = 3,
    space: Mapping[str, Span] = TREE_SPACE,
) -> tuple[dict[str, object], DataFrame]:
    """Successive halving: all candidates on a small sample, the best 1/keep of them on keep times as many rows, and so on.

    Samples are drawn by a hash of the key under one seed, so each rung's rows contain those of the rung below. Errors are
    WAPE on the newest training origin, all its rows. Returns the last candidate's parameters and one row per fit:
    rung, candidate, parameters, fraction, fit_rows, wape, kept (goes on, or is the result).
    """
    keys = ["series_id", "origin_day", "horizon"]
    fit_rows, judge_rows = validation_split(train)
    dictionary = staged(fit_categories(fit_rows), "categories")
    drawn = drawn_candidates(space, trials, seed)
    alive, results = list(range(trials)), []
    plan = rungs(trials, keep, fraction)
    for rung, (_, share) in enumerate(plan):
        sample = fit_rows if share >= 1 else _sampled(fit_rows, keys, share, seed, "halving")
        size = sample.count()

        def error(n: int, sample: DataFrame = sample) -> float:
            fitted = DirectForecaster(kind, drawn[n], seed, dictionary=dictionary).fit_model(sample)
            return weighted_miss(fitted.points(judge_rows))

        errors = dict(zip(alive, side_by_side([functools.partial(error, n) for n in alive]), strict=True))
        best = sorted(alive, key=lambda n: (errors[n], n))
        stay = best[: plan[rung + 1][0] if rung + 1 < len(plan) else 1]
        results += [(rung, n, {k: str(v) for k, v in drawn[n].items()}, share, size, errors[n], n in stay) for n in alive]
        alive = sorted(stay)
        if sample is not fit_rows:
            dropped(sample)
    table = train.sparkSession.createDataFrame(
        results,
        "rung int, candidate int, parameters map<string,string>, fraction double, fit_rows long, wape double, kept boolean",
    )
    return drawn[alive[0]], table


def without_summary(model: LogisticRegressionModel, spark: SparkSession) -> LogisticRegressionModel:
    """The fitted model as stored and read back.

    The summary of its training holds the session and goes to every task with the model; a session that has observed a write
    or carries a tag cannot be sent.
    """
    path = f"{staging_root(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def hurdle_forecast(fit_rows: DataFrame, scoring: DataFrame, seed: int = 42) -> DataFrame:
    """Probability of a sale times the expected amount given a sale."""
    amount = DirectForecaster("poisson", seed=seed).fit_model(fit_rows.where(F.col("target") > 0))
    shape = DirectForecaster("poisson", seed=seed, features=amount.features, dictionary=staged(fit_categories(fit_rows), "hurdle"))
    labelled = shape.vectors(fit_rows).select("features", (F.col("target") > 0).cast("double").alias("label"))
    chance = LogisticRegression(regParam=0.01, maxIter=25, probabilityCol="_chance").fit(staged(labelled, "hurdle-fit"))
    chance = without_summary(chance, fit_rows.sparkSession)
    keys = ["series_id", "origin_day", "horizon"]
    sold = chance.transform(shape.vectors(scoring)).select(
        *keys, vector_to_array("_chance").getItem(1).alias("sale_probability")
    )
    sized = amount.points(scoring).withColumnRenamed("yhat", "sale_amount")
    return sized.join(sold, keys).withColumn("yhat", F.col("sale_probability") * F.col("sale_amount"))


# Losses compared on one held-out fold.
OBJECTIVES: dict[str, tuple[str, dict[str, object]]] = {
    "tweedie_1.1": ("tweedie", {"variancePower": 1.1}),
    "tweedie_1.2": ("tweedie", {"variancePower": 1.2}),
    "tweedie_1.5": ("tweedie", {"variancePower": 1.5}),
    "l1": ("absolute", {}),
    "quantile_0.5": ("quantile_trees", {"level": 0.5, "rounds": 8}),
    "poisson": ("poisson", {}),
    "huber": ("huber", {}),
}


def compare_objectives(
    train: DataFrame, evaluation: DataFrame, variants: Mapping[str, tuple[str, dict[str, object]]] = OBJECTIVES, seed: int = 42
) -> DataFrame:
    """Evaluation error per loss: raw, after the scale that removes validation bias, and after threshold and scale.

    Scale, and threshold with its own scale, are searched on the validation rows and applied to the evaluation rows.
    """
    fit_rows, validation = validation_split(train)
    dictionary = staged(fit_categories(fit_rows), "categories")

    def row(name: str, kind: str, params: Mapping[str, object]) -> tuple[object, ...]:
        model = DirectForecaster(kind, params, seed, dictionary=dictionary).fit_model(fit_rows)
        return (name, *adjusted_errors(model.points(validation), model.points(evaluation)))

    rows = side_by_side([functools.partial(row, name, *variant) for name, variant in variants.items()])
    return train.sparkSession.createDataFrame(rows, f"variant string, {ERROR_SCHEMA}")


# Columns of `adjusted_errors`.
ERROR_SCHEMA = (
    "scale double, raw_wape double, raw_bias double, adjusted_wape double, adjusted_bias double, "
    "threshold double, cut_scale double, cut_wape double, cut_bias double"
)


def adjusted_errors(validation: DataFrame, evaluation: DataFrame) -> tuple[float, ...]:
    """The values of ERROR_SCHEMA for forecasts (target, yhat) of both parts."""
    judged = staged(validation.select("target", "yhat"), "objective")
    best = unbiased_scale_search(judged).first()
    scale = float(best["scale"]) if best is not None else 1.0
    cut = threshold_scale_search(judged).first()
    threshold, cut_scale = (float(cut["threshold"]), float(cut["scale"])) if cut is not None else (0.0, 1.0)
    y, yhat = F.col("target"), F.col("yhat")
    size = floored(F.sum(F.abs(y)))
    ways = (yhat, yhat * scale, F.when(yhat < threshold, 0.0).otherwise(yhat) * cut_scale)
    sums = [(F.sum(how(way - y)) / size).alias(f"v{k}{n}") for k, way in enumerate(ways) for n, how in enumerate((F.abs, lambda v: v))]
    found = evaluation.select("target", "yhat").agg(*sums).first()
    dropped(judged)
    return (scale, *found[:4], threshold, cut_scale, *found[4:])


def blend_errors(model: DirectForecaster, validation: DataFrame, evaluation: DataFrame) -> tuple[float, ...]:
    """weight, scale, validation_wape, evaluation_wape, evaluation_bias of the best blend with the seasonal mean.

    Weight and scale come from the validation rows; rows without any known lag are left out, as they have no mean.
    """
    lagged = {"seasonal": seasonal_mean()}
    known = model.points(validation).withColumns(lagged).where(F.col("seasonal").isNotNull())
    best = blend_search(known, "yhat", "seasonal").first()
    if best is None:
        raise ValueError("no blend keeps the bias limit on the validation rows")
    weight, scale = float(best["weight"]), float(best["scale"])
    asked = model.points(evaluation).withColumns(lagged).where(F.col("seasonal").isNotNull())
    miss = (weight * F.col("yhat") + (1.0 - weight) * F.col("seasonal")) * scale - F.col("target")
    size = floored(F.sum(F.abs("target")))
    found = asked.agg((F.sum(F.abs(miss)) / size).alias("w"), (F.sum(miss) / size).alias("b")).first()
    return weight, scale, float(best["wape"]), found["w"], found["b"]
