"""Sources and sinks, models, custom predictors, streaming, entry contract."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frametide.operators import models as M
from frametide.operators.udf import custom_predict
from frametide.operators.validate import ErrorType, ValidationError
from frametide.plans import fixtures as fx
from frametide.plans.score import score_test
from frametide.plans.train import train
from frametide.schemas import TRACKING_INPUT
from frametide.session import staging_path
from frametide.sources import files, sinks
from tests.conftest import SF_SMALL


def test_empty_glob_gives_empty_frame(spark):
    # L16
    df = files.scan_inputs(spark, "/nonexistent/dir")
    assert df.count() == 0
    assert set(TRACKING_INPUT.names) <= set(df.columns) and "week" in df.columns


def test_weekly_csv_round_trip(spark):
    frames = fx.frames_events(spark, SF_SMALL)
    root = staging_path(spark, "t-weekly")
    pattern = files.write_weekly_csv(frames, root, "input")
    back = files.scan_inputs(spark, schema=frames.drop("week").schema, pattern=pattern)
    assert sorted(back.collect()) == sorted(frames.select(*back.columns).collect())


def test_result_json_caps_details(spark):
    path = staging_path(spark, "t-result")
    sinks.write_result_json(spark, path, ValidationError(ErrorType.INVALID_SUBMISSION, "x" * 9000))
    row = spark.read.schema(sinks.RESULT).json(path).first()
    assert row["Succeeded"] is False and row["ErrorType"] == 6 and len(row["ErrorDetails"]) == 8000
    ok = staging_path(spark, "t-result-ok")
    sinks.write_result_json(spark, ok, None)
    assert spark.read.schema(sinks.RESULT).json(ok).first()["Succeeded"] is True


def test_metadata_round_trip(spark):
    path = staging_path(spark, "t-meta")
    meta = {"feature_columns": ["a"], "ensemble_weights": {"a": 1.0}}
    sinks.write_model_metadata(spark, path, meta)
    assert sinks.read_model_metadata(spark, path) == meta


@pytest.fixture(scope="module")
def trained(spark):
    root = staging_path(spark, "t-models")
    result = train(
        spark, fx.frames_events(spark, SF_SMALL), fx.labels_events(spark, SF_SMALL),
        order_col="row_id", max_iter=5, output_root=root,
    )
    return result


def test_model_beats_mean_predictor(spark, trained):
    labels = fx.labels_events(spark, SF_SMALL)
    stats = labels.agg(F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy")).first()
    assert trained.metrics["ensemble_rmse_x"] < stats["sx"]
    assert trained.metrics["x_all_finite"] and not trained.metrics["x_any_nan"]
    assert set(trained.bundle.metrics) >= {"a_rmse_x", "b_rmse_y", "combined_rmse"}


def test_newest_whole_model_is_scored(spark, trained, tmp_path):
    import shutil

    from frametide.plans.score import score_request
    from frametide.sources.catalogue import model_catalogue, newest_model, resolve_model

    root = str(tmp_path / "models")
    versions = ["20240101_000000", "20240202_000000", "20240303_000000", "20240404_000000"]
    paths = [M.save_bundle(spark, trained.bundle, root, v) for v in versions]
    shutil.rmtree(next((tmp_path / "models").glob(f"ensemble_v{versions[2]}/model/stages/2_*/data")))
    shutil.rmtree(f"{paths[3]}/metadata")
    (tmp_path / "models" / "ensemble_vnotes").mkdir()
    got = {r["version"][-15:]: (r["n_stages"], r["n_stages_found"], r["required_keys"], r["complete"]) for r in model_catalogue(spark, root).collect()}
    assert got == {versions[0]: (5, 5, True, True), versions[1]: (5, 5, True, True), versions[2]: (5, 4, True, False), versions[3]: (5, 5, False, False)}
    assert newest_model(spark, root) == paths[1] == resolve_model(spark, f"{root}/latest") and resolve_model(spark, paths[0]) == paths[0]
    requests = staging_path(spark, "t-latest")
    fx.frames_events(spark, SF_SMALL).withColumn("id", F.col("row_id").cast("string")).write.json(requests)
    by_name = score_request(spark, requests, paths[1]).orderBy("id").collect()
    assert score_request(spark, requests, f"{root}/latest").orderBy("id").collect() == by_name
    assert model_catalogue(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(FileNotFoundError):
        newest_model(spark, str(tmp_path / "none"))


def test_saved_bundle_scores_identically(spark, trained):
    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)
    a = score_test(test, ti, trained.bundle).orderBy("id").collect()
    loaded = M.load_bundle(spark, trained.path)
    b = score_test(test, ti, loaded).orderBy("id").collect()
    assert a == b and len(a) == test.count()
    meta = sinks.read_model_metadata(spark, f"{trained.path}/metadata")
    assert meta["player_position_values"] == loaded.vocabulary
    assert meta["best_params"]["a"]["maxDepth"] == 8 and loaded.params == trained.bundle.params


def test_per_play_scoring_equals_all_at_once(spark, trained):
    # The stored vocabulary makes a single play's codes equal the full run's
    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)
    full = {r["id"]: (r["x"], r["y"]) for r in score_test(test, ti, trained.bundle).collect()}
    first = test.select("game_id", "play_id").orderBy("game_id", "play_id").first()
    one = test.where((F.col("game_id") == first[0]) & (F.col("play_id") == first[1]))
    part = {r["id"]: (r["x"], r["y"]) for r in score_test(one, ti, trained.bundle).collect()}
    assert part and all(full[k] == v for k, v in part.items())


def test_custom_predict_and_lambda_rejected(spark):
    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)

    def constant(test_rows: pd.DataFrame, input_rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"x": [1.0] * len(test_rows), "y": [2.0] * len(test_rows)})

    out = custom_predict(test, ti, constant)
    assert out.count() == test.count()
    assert out.agg(F.min("x"), F.max("y")).first() == (1.0, 2.0)
    with pytest.raises(ValidationError):
        custom_predict(test, ti, lambda a, b: a)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(fn.__doc__ for fn in entry.queries().values())


def test_some_queries_match_duckdb_at_small_scale(spark):
    import duckdb

    import __spark_entry__ as entry
    from tools.oracle_check import compare

    con = duckdb.connect()
    for t in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    names = ["play_motion_summary", "time_lag_features", "prepare_features", "join_inputs_outputs", "rmse_by_model", "check_row_alignment"]
    for name in names:
        ok, msg = compare(name, entry.queries()[name](spark, SF_SMALL).toPandas(), con.execute(entry.oracle_sql()[name]).df())
        assert ok, f"{name}: {msg}"


def test_fit_without_validation_column(spark):
    rows = fx.frames_events(spark, SF_SMALL).withColumns({"x_target": F.col("x") * 0.9, "y_target": F.col("y") * 0.9})
    from frametide.operators.features import prepare_features

    feats, cols = prepare_features(rows)
    bundle = M.fit_models(feats, M.ENSEMBLE_PARAMS, cols, validation="is_val", max_iter=2)
    assert bundle.families == ["a", "b"] and M.score(bundle, feats).count() == feats.count()


def test_row_local_predict(spark):
    from frametide.operators.udf import row_local_predict

    rows = fx.test_input_events(spark, SF_SMALL).withColumn("id", F.col("row_id").cast("string"))

    def shift(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"x": pdf["x"] + 1.0, "y": pdf["y"] - 1.0})

    out = row_local_predict(rows, shift)
    got = {r["id"]: (r["x"], r["y"]) for r in out.collect()}
    exp = {r["id"]: (r["x"] + 1.0, r["y"] - 1.0) for r in rows.select("id", "x", "y").collect()}
    assert got == exp


def _short(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"x": [1.0], "y": [1.0]})


def _texts(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"x": ["1"] * len(pdf), "y": [1.0] * len(pdf)})


def _with_id(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"id": range(len(pdf)), "x": [1.0] * len(pdf), "y": [1.0] * len(pdf)})


def _missing(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"x": [float("nan")] * len(pdf), "y": [1.0] * len(pdf)})


@pytest.mark.parametrize("fn", [_short, _texts, _with_id, _missing])
def test_bad_answers_are_refused(fn):
    from frametide.operators.udf import checked_values

    rows = pd.DataFrame({"id": ["a", "b", "c"], "x": [1.0, 2.0, 3.0]})
    with pytest.raises(ValueError):
        checked_values(fn(rows), rows["id"], ["x", "y"], "id", False)


def test_single_family_runs_all_rounds(spark):
    from frametide.operators.features import prepare_features

    rows = fx.frames_events(spark, SF_SMALL).withColumns({"x_target": F.col("x") * 0.9, "y_target": F.col("y") * 0.9, "is_val": F.col("row_id") % 7 == 0})
    feats, cols = prepare_features(rows)
    bundle = M.fit_models(feats, {"gbt": M.SINGLE_PARAMS}, cols, vocabulary=[], max_iter=6)
    assert set(bundle.info.values()) == {6} and bundle.vocabulary == []


def test_best_round_waits_for_patience():
    assert M.best_round([5.0, 4.0, 4.5, 4.2, 3.0, 3.5], 2) == (2, True)
    assert M.best_round([5.0, 4.0, 4.5, 4.2, 3.0, 3.5], 3) == (5, False)
    assert M.best_round([1.0], 3) == (1, False)


def test_patient_fit_stops_where_the_error_rises(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    # The validation labels fit the first rounds only: learning on raises their error.
    rows = spark.range(400, numPartitions=2).selectExpr("cast(id % 20 as double) as f", "id % 4 = 0 as is_val", "cast(id % 20 as double) as full")
    rows = rows.selectExpr("f", "is_val", "case when is_val then 9.5 + (full - 9.5) * 0.5 else full end as label")
    rows = VectorAssembler(inputCols=["f"], outputCol="features").transform(rows).cache()
    est = GBTRegressor(labelCol="label", maxIter=12, maxDepth=2, stepSize=0.3, seed=1)
    monkeypatch.setattr(M, "FIRST_ROUNDS", 4)
    losses = est.fit(rows.where("not is_val")).evaluateEachIteration(rows.where("is_val"), "squared")
    model = M.fit_patient(est, rows.where("not is_val"), rows.where("is_val"), 2)
    assert len(model.trees) == M.best_round(losses, 2)[0] < 12
