"""Model operators (M1-M9): fitting, scoring, evaluation and persistence with
Spark ML.

One ``Pipeline`` holds the ``VectorAssembler`` and every regressor (x and y
per model family), so an ensemble is a single ``PipelineModel`` artifact and
scoring is one projection over the feature rows. Tree learners work on the
bounded training sample (O3), while feature engineering and scoring run over
whole tables.
"""

from __future__ import annotations

import copy
import datetime as _dt
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frametide.operators import metrics
from frametide.operators.blend import blend_weighted
from frametide.schemas import FEATURE_COLUMNS
from frametide.session import checkpoint_dir

# Regressor settings of the single-model trainer (x and y).
SINGLE_PARAMS = {
    "x": {"stepSize": 0.2, "maxIter": 400, "maxDepth": 5, "maxBins": 255, "minInstancesPerNode": 100},
    "y": {"stepSize": 0.1, "maxIter": 400, "maxDepth": 8, "maxBins": 127, "minInstancesPerNode": 100},
}
# The two ensemble families. Family "a" is boosted with row and
# feature subsampling (0.8 / 0.8), learning rate 0.05, depth 8, at least 100
# rows per leaf, 500 rounds, cut at the best validation round once 50 rounds
# brought nothing better; family "b" is a bagged forest with the same
# sampling, depth and leaf size. maxMemoryInMB only sizes the per-executor
# histogram buffers (fewer passes per tree level), not the model.
ENSEMBLE_PARAMS = {
    "a": {
        "kind": "gbt",
        "stepSize": 0.05,
        "maxIter": 500,
        "patience": 50,
        "maxDepth": 8,
        "minInstancesPerNode": 100,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
        "maxMemoryInMB": 1024,
    },
    "b": {
        "kind": "forest",
        "numTrees": 100,
        "maxDepth": 8,
        "minInstancesPerNode": 100,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
        "maxMemoryInMB": 1024,
    },
}
# Equal blend weights, the training seed and the cap on rows
# handed to the learners (a uniform sample above it).
DEFAULT_WEIGHTS = {"a": 0.5, "b": 0.5}
SEED = 42
MAX_TRAIN_ROWS = 200_000


@dataclass
class ModelBundle:
    """A fitted model set plus everything scoring needs."""

    model: PipelineModel
    feature_columns: list[str]
    families: list[str]
    weights: dict[str, float]
    vocabulary: list[str] | None = None
    metrics: dict[str, float] = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)

    def metadata(self, version: str) -> dict:
        return {
            "timestamp": version,
            "feature_columns": list(self.feature_columns),
            "player_position_values": None if self.vocabulary is None else list(self.vocabulary),
            "ensemble_weights": dict(self.weights),
            "families": list(self.families),
            "model_files": {"pipeline": "model"},
            "metrics": dict(self.metrics),
            "model_info": dict(self.info),
            "best_params": dict(self.params),
        }


def _regressor(kind: str, label: str, prediction: str, params: Mapping):
    p = {k: v for k, v in params.items() if k not in ("kind", "patience")}
    if kind == "forest":
        return RandomForestRegressor(
            featuresCol="features", labelCol=label, predictionCol=prediction, seed=SEED, **p
        )
    return GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, seed=SEED, checkpointInterval=10, **p
    )


def build_pipeline(
    families: Mapping[str, Mapping],
    feature_columns: Sequence[str] = FEATURE_COLUMNS,
    labels: Mapping[str, str] | None = None,
) -> Pipeline:
    """Assembler + one regressor per (family, axis); predictions land in
    ``<family>_x`` / ``<family>_y``. ``families`` maps a family name to its
    parameters; per-axis parameters may be given under keys "x" and "y"."""
    labels = labels or {"x": "x_target", "y": "y_target"}
    stages = [VectorAssembler(inputCols=list(feature_columns), outputCol="features", handleInvalid="keep")]
    for fam, params in families.items():
        for axis, label in labels.items():
            p = dict(params.get(axis, params)) if axis in params else dict(params)
            p = {k: v for k, v in p.items() if k not in ("x", "y")}
            kind = p.get("kind", "gbt")
            stages.append(_regressor(kind, label, f"{fam}_{axis}", p))
    return Pipeline(stages=stages)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (lineage cut;
    survives executor loss without recomputing the sample)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _with_max_iter(families: Mapping[str, Mapping], max_iter: int | None) -> dict:
    fams = copy.deepcopy({k: dict(v) for k, v in families.items()})
    if max_iter is not None:
        for p in fams.values():
            for target in [p] + [p[a] for a in ("x", "y") if a in p]:
                if "maxIter" in target:
                    target["maxIter"] = max_iter
                if "numTrees" in target:
                    target["numTrees"] = min(target["numTrees"], max_iter)
    return fams


# Rounds of the first try of a patient fit; every further try has twice as many.
FIRST_ROUNDS = 100


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of the lowest loss before ``patience`` rounds
    passed without a lower one, and whether they did pass."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_patient(est: GBTRegressor, training_rows: DataFrame, validation_rows: DataFrame, patience: int):
    """Boosting with round-count patience: the model holds the trees up to its
    best validation round. Spark cannot go on from a fitted model, so the
    number of rounds doubles until patience runs out or ``maxIter`` is
    reached; equal seeds give equal first trees, and a last fit of the best
    number of rounds cuts the model there."""
    most = est.getMaxIter()
    rounds = min(most, max(FIRST_ROUNDS, 2 * patience))
    while True:
        model = est.copy({est.maxIter: rounds}).fit(training_rows)
        best, settled = best_round(model.evaluateEachIteration(validation_rows, "squared"), patience)
        if settled or rounds == most:
            break
        rounds = min(most, 2 * rounds)
    return model if best == rounds else est.copy({est.maxIter: best}).fit(training_rows)


def fit_models(
    train: DataFrame,
    families: Mapping[str, Mapping],
    feature_columns: Sequence[str] = FEATURE_COLUMNS,
    validation: str | None = "is_val",
    weights: Mapping[str, float] | None = None,
    vocabulary: Sequence[str] | None = None,
    max_iter: int | None = None,
    labels: Mapping[str, str] | None = None,
) -> ModelBundle:
    """M1 / M2: fit one regressor per (family, axis).

    The feature vector is assembled once and only the columns the learners
    read are checkpointed. The regressors are independent, so they are
    fitted concurrently (one driver thread each, i.e. concurrent Spark jobs
    sharing the executors). All are fitted on the training rows only; those
    that state a ``patience`` are cut at their best validation round (stored
    as the number of trees in ``info``), the others run all their rounds."""
    fams = _with_max_iter(families, max_iter)
    labels = labels or {"x": "x_target", "y": "y_target"}
    use_val = bool(validation) and validation in train.columns
    template = build_pipeline(fams, feature_columns, labels)
    assembler, estimators = template.getStages()[0], template.getStages()[1:]
    cols = ["features", *labels.values(), *([validation] if use_val else [])]
    data = durable(assembler.transform(train).select(*cols))
    training_rows = data.where(~F.col(validation)) if use_val else data

    validation_rows = data.where(F.col(validation)) if use_val else None
    if use_val and validation_rows.isEmpty():
        validation_rows = None

    def fit_one(est):
        family = est.getPredictionCol().rsplit("_", 1)[0]
        patience = fams[family].get("patience")
        if patience and validation_rows is not None:
            return fit_patient(est, training_rows, validation_rows, patience)
        return est.fit(training_rows)

    with ThreadPoolExecutor(max_workers=max(1, len(estimators))) as pool:
        fitted = list(pool.map(fit_one, estimators))
    model = PipelineModel(stages=[assembler, *fitted])
    w = dict(weights) if weights is not None else {k: 1.0 / len(fams) for k in fams}
    info = {f"{s.getPredictionCol()}_trees": len(s.trees) for s in fitted if hasattr(s, "trees")}
    return ModelBundle(model, list(feature_columns), list(fams), w, None if vocabulary is None else list(vocabulary), info=info, params=fams)


def score(bundle: ModelBundle, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """M3 + M4: per-family predictions and the weighted blend ``x``, ``y``."""
    scored = bundle.model.transform(features)
    blend = {
        "x": blend_weighted({f"{f}_x": bundle.weights[f] for f in bundle.families}),
        "y": blend_weighted({f"{f}_y": bundle.weights[f] for f in bundle.families}),
    }
    cols = [*keep, *[f"{f}_{a}" for f in bundle.families for a in ("x", "y")]]
    return scored.select(*cols, blend["x"].alias("x"), blend["y"].alias("y"))


def evaluate(bundle: ModelBundle, val: DataFrame, tx: str = "x_target", ty: str = "y_target") -> dict[str, float]:
    """M5: per-family and blended RMSE (A4), blended prediction range (A5)
    and finiteness (A6) on validation rows - a single aggregation job. A
    missing prediction makes its RMSE NaN."""
    scored = score(bundle, val, keep=[tx, ty])
    models = {f: (f"{f}_x", f"{f}_y") for f in bundle.families}
    models["ensemble"] = ("x", "y")
    aggs = []
    for name, (px, py) in models.items():
        for axis, pred, truth in (("x", px, tx), ("y", py, ty)):
            aggs.append(metrics.mse(pred, truth).alias(f"{name}_mse_{axis}"))
    for c in ("x", "y"):
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean")]
        aggs += [
            F.coalesce(F.bool_or(F.col(c).isNull() | F.isnan(c)), F.lit(False)).alias(f"{c}_any_nan"),
            F.coalesce(F.every(F.coalesce(metrics.is_finite(F.col(c)), F.lit(False))), F.lit(True)).alias(f"{c}_all_finite"),
        ]
    aggs.append(F.count(F.lit(1)).alias("n_val"))
    row = scored.agg(*aggs).first().asDict()
    out: dict = {}
    for name in models:
        for axis in ("x", "y"):
            mse = row.pop(f"{name}_mse_{axis}")
            out[f"{name}_rmse_{axis}"] = math.sqrt(mse) if mse is not None else float("nan")
    out["combined_rmse"] = math.sqrt((out["ensemble_rmse_x"] ** 2 + out["ensemble_rmse_y"] ** 2) / 2)
    out.update(row)
    return out


def version_stamp(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def save_bundle(spark: SparkSession, bundle: ModelBundle, root: str, version: str | None = None) -> str:
    """M6: ``<root>/ensemble_v<timestamp>/`` with the pipeline and metadata."""
    from frametide.sources.sinks import write_model_metadata

    version = version or version_stamp()
    path = f"{root.rstrip('/')}/ensemble_v{version}"
    bundle.model.write().overwrite().save(f"{path}/model")
    write_model_metadata(spark, f"{path}/metadata", bundle.metadata(version))
    return path


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    """M7: pipeline + metadata back into a bundle."""
    from frametide.sources.sinks import read_model_metadata

    meta = read_model_metadata(spark, f"{path.rstrip('/')}/metadata")
    model = PipelineModel.load(f"{path.rstrip('/')}/{meta['model_files']['pipeline']}")
    return ModelBundle(
        model,
        meta["feature_columns"],
        meta["families"],
        meta["ensemble_weights"],
        meta.get("player_position_values"),
        meta.get("metrics", {}),
        meta.get("model_info", {}),
        meta.get("best_params", {}),
    )
