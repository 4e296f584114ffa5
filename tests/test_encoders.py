"""Categorical codes (P6-P8, A7) and the distributed index."""

from pyspark.sql import functions as F

from frametide.functions.encoders import (
    category_code_first_seen,
    category_code_sorted,
    category_code_vocab,
    dense_index,
    fit_first_seen_vocabulary,
    fit_sorted_vocabulary,
    lazy_index,
)


def _positions(spark):
    return spark.createDataFrame([(0, "WR"), (1, "CB"), (2, None), (3, "TE"), (4, "WR")], "row_id long, player_position string")


def test_sorted_codes(spark):
    # L4: alphabetical codes, null -> -1
    got = [r[0] for r in category_code_sorted(_positions(spark)).orderBy("row_id").select("player_pos_code").collect()]
    assert got == [2, 0, -1, 1, 2]
    assert fit_sorted_vocabulary(_positions(spark), "player_position") == ["CB", "TE", "WR"]


def test_first_seen_codes(spark):
    got = [r[0] for r in category_code_first_seen(_positions(spark), order_col="row_id").orderBy("row_id").select("player_pos_code").collect()]
    assert got == [0, 1, -1, 2, 0]
    assert fit_first_seen_vocabulary(_positions(spark), "player_position", "row_id") == ["WR", "CB", "TE"]


def test_vocab_codes(spark):
    df = spark.createDataFrame([("CB",), ("ZZ",), (None,)], "player_position string")
    got = [r[0] for r in category_code_vocab(df, ["SS", "CB"]).select("player_pos_code").collect()]
    assert got == [1, -1, -1]


def test_absent_column_code_zero(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert category_code_sorted(df).first()["player_pos_code"] == 0


N_POSITIONS = 50_000


def _many_positions(spark):
    value = F.format_string("v%05d", (F.col("id") * 37) % N_POSITIONS)
    return spark.range(0, N_POSITIONS).select(value.alias("player_position"), F.col("id").alias("row_id"))


def test_many_values_are_coded(spark):
    df = _many_positions(spark)
    by_value = category_code_sorted(df).where(F.col("player_pos_code") != F.substring("player_position", 2, 5).cast("int"))
    assert by_value.count() == 0
    assert category_code_first_seen(df, order_col="row_id").where(F.col("player_pos_code") != F.col("row_id")).count() == 0
    vocabulary = [f"v{i:05d}" for i in range(N_POSITIONS - 1, 0, -1)]
    coded = category_code_vocab(df, vocabulary).withColumn("n", F.substring("player_position", 2, 5).cast("int"))
    assert coded.where(F.col("player_pos_code") != F.when(F.col("n") == 0, -1).otherwise(N_POSITIONS - 1 - F.col("n"))).count() == 0


def test_building_a_query_starts_no_job(spark):
    from frametide.operators.features import prepare_features, xy_legacy_features
    from frametide.operators.metrics import distinct_in_order

    frame = ["x", "y", "s", "a", "dir", "num_frames_output", "absolute_yardline_number"]
    df = _many_positions(spark).withColumns({c: F.col("row_id") * 1.0 for c in frame})
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        built = [
            category_code_sorted(df),
            category_code_first_seen(df),
            category_code_vocab(df, ["a"] * 100),
            prepare_features(df)[0],
            prepare_features(df, encoder="first_seen", order_col="row_id")[0],
            xy_legacy_features(df),
            distinct_in_order(df, "player_position", "row_id"),
        ]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
        assert all(b.count() == N_POSITIONS for b in built)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lazy_index_over_order_types(spark):
    import random

    rng = random.Random(3)
    values = [rng.choice(["", "a", "ab", "abc", "b\u00e9", "\U0001f600", "zz"]) + str(rng.randrange(900)) for _ in range(800)]
    rows = [(v, rng.randrange(-(10**6), 10**6) if i % 50 else None, float(i % 9)) for i, v in enumerate(dict.fromkeys(values))]
    df = spark.createDataFrame(rows, "v string, n bigint, d double").withColumn("t", F.timestamp_seconds(F.col("n")))
    for order in (["v"], ["n", "v"], ["d", "v"], ["t", "v"]):
        got = [(r["code"], r["v"]) for r in lazy_index(df.repartition(5), order).collect()]
        at = [("v", "n", "d", "n")["vndt".index(order[0])], "v"]
        name = {"v": 0, "n": 1, "d": 2}
        want = sorted(rows, key=lambda r: [(r[name[c]] is not None, r[name[c]].encode() if isinstance(r[name[c]], str) else r[name[c]]) for c in at])
        assert [v for _, v in sorted(got)] == [r[0] for r in want]


def test_dense_index_matches_global_rank(spark):
    df = spark.range(0, 2000).select(((F.col("id") * 7919) % 2003).alias("v")).repartition(7)
    idx = dense_index(df, ["v"], "code").collect()
    got = sorted((r["v"], r["code"]) for r in idx)
    assert [c for _, c in got] == list(range(2000))
