"""Streaming equals batch scoring; plan shape of the scoring job."""

from pyspark.sql import functions as F

from frametide.operators import models as M
from frametide.plans import fixtures as fx
from frametide.plans.score import score_test
from frametide.plans.train import train
from frametide.schemas import PLAY_KEYS
from frametide.session import staging_path
from frametide.streaming.play_stream import play_batches, score_stream, write_play_files
from tests.conftest import SF_SMALL


def test_stream_scoring_equals_batch_and_is_resumable(spark):
    result = train(spark, fx.frames_events(spark, SF_SMALL), fx.labels_events(spark, SF_SMALL), order_col="row_id", max_iter=3)
    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)
    root = staging_path(spark, "t-stream")
    write_play_files(test, f"{root}/source", files_per_batch=4)
    score_stream(spark, f"{root}/source", test.schema, ti, result.bundle, f"{root}/sink", f"{root}/ckpt", 2)
    streamed = spark.read.parquet(f"{root}/sink")
    assert streamed.select(F.countDistinct("batch_id")).first()[0] >= 2
    batch = {r["id"]: (r["x"], r["y"]) for r in score_test(test, ti, result.bundle).collect()}
    got = {r["id"]: (r["x"], r["y"]) for r in streamed.collect()}
    assert got == batch
    # a restart with the same checkpoint finds nothing new to score
    score_stream(spark, f"{root}/source", test.schema, ti, result.bundle, f"{root}/sink", f"{root}/ckpt", 2)
    assert spark.read.parquet(f"{root}/sink").count() == len(batch)
    # a fresh checkpoint re-runs every batch: the sink is overwritten per
    # batch, not appended to, so no prediction is duplicated
    score_stream(spark, f"{root}/source", test.schema, ti, result.bundle, f"{root}/sink", f"{root}/ckpt2", 2)
    assert spark.read.parquet(f"{root}/sink").count() == len(batch)


def test_play_batches_order(spark):
    test = fx.test_events(spark, SF_SMALL)
    tagged = play_batches(test, "id")
    assert tagged.count() == test.count()
    firsts = tagged.groupBy("batch_index").agg(F.min("id").alias("m")).orderBy("batch_index").collect()
    assert [r["m"] for r in firsts] == sorted(r["m"] for r in firsts)


def test_scoring_plan_has_no_python_and_no_single_partition(spark):
    result = train(spark, fx.frames_events(spark, SF_SMALL), fx.labels_events(spark, SF_SMALL), order_col="row_id", max_iter=2)
    preds = score_test(fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL), result.bundle)
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "SinglePartition" not in plan
    assert M.ModelBundle  # bundle type exported


def test_cluster_keys_share_one_exchange_per_side(spark):
    """J1 on four keys + W5 on three: with both sides pre-partitioned on the
    player keys the join and the window reuse one exchange per side."""
    from frametide.operators.joins import join_inputs_outputs
    from frametide.operators.lags import time_lag_features
    from frametide.schemas import PLAYER_KEYS

    frames, labels = fx.frames_events(spark, SF_SMALL), fx.labels_events(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shared = time_lag_features(join_inputs_outputs(frames, labels, cluster_keys=PLAYER_KEYS), tiebreak=["row_id", "x_target"])
        plain = time_lag_features(join_inputs_outputs(frames, labels), tiebreak=["row_id", "x_target"])
        count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert count(shared) == 2 and count(plain) == 3
        assert sorted(shared.collect()) == sorted(plain.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_week_partitioned_scan_prunes(spark):
    from frametide.sources.layout import scan_weeks, weeks_after, write_week_partitioned

    frames = fx.frames_events(spark, SF_SMALL)
    path = staging_path(spark, "t-by-week")
    write_week_partitioned(frames, path)
    late = scan_weeks(spark, path, weeks_after(3)).select("row_id", "x", "week")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week" in plan and "(week#" in plan
    assert "ReadSchema: struct<row_id:bigint,x:double>" in plan
    assert sorted(r["row_id"] for r in late.collect()) == sorted(r["row_id"] for r in frames.where("week > 3").collect())


def test_label_filter_and_columns_reach_the_scan(spark):
    labels = fx.labels_lineitem(spark, SF_SMALL)
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in plan
    read = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert "l_tax" not in read and "l_shipdate" not in read


def test_a_batch_reads_the_buckets_of_its_plays(spark):
    from frametide.sources.layout import PlayStore

    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)
    store = PlayStore(staging_path(spark, "t-plays"), buckets=16).write(ti)
    whole = spark.read.parquet(store.root).inputFiles()
    plays = [r for r in test.select(*PLAY_KEYS).distinct().orderBy(*PLAY_KEYS).collect()]
    read = []
    for n in (1, 3, len(plays)):
        batch = test.join(spark.createDataFrame(plays[:n], test.select(*PLAY_KEYS).schema), PLAY_KEYS, "left_semi")
        frames = store.of(batch)
        assert set(frames.columns) == set(ti.columns)
        read.append(len(frames.select("x", F.input_file_name().alias("f")).select("f").distinct().collect()))
        want = ti.join(batch.select(*PLAY_KEYS).distinct(), PLAY_KEYS, "left_semi").select(*ti.columns)
        got = frames.join(batch.select(*PLAY_KEYS).distinct(), PLAY_KEYS, "left_semi").select(*ti.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert read[0] == 1 and read[0] < read[1] <= 3 * read[0] and read[-1] <= len(whole)
    assert store.of(test.where("false")).count() == 0
    empty = PlayStore(staging_path(spark, "t-none"), buckets=4).write(ti.where("false"))
    assert empty.of(test).collect() == [] and set(empty.of(test).columns) == set(ti.columns)


def test_stream_over_a_play_store_equals_batch(spark):
    from frametide.sources.layout import PlayStore

    result = train(spark, fx.frames_events(spark, SF_SMALL), fx.labels_events(spark, SF_SMALL), order_col="row_id", max_iter=2)
    test, ti = fx.test_events(spark, SF_SMALL), fx.test_input_events(spark, SF_SMALL)
    root = staging_path(spark, "t-stream-store")
    write_play_files(test, f"{root}/source", files_per_batch=4)
    store = PlayStore(f"{root}/inputs", buckets=8).write(ti)
    score_stream(spark, f"{root}/source", test.schema, store, result.bundle, f"{root}/sink", f"{root}/ckpt", 1)
    batch = {r["id"]: (r["x"], r["y"]) for r in score_test(test, ti, result.bundle).collect()}
    assert {r["id"]: (r["x"], r["y"]) for r in spark.read.parquet(f"{root}/sink").collect()} == batch
