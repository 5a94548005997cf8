"""Feature operators on literal rows (traps T1-T3, T6, T7) and metamorphic checks."""

from pyspark.sql import functions as F

from cartlake.operators import features as fx
from cartlake.plans import registry as R
from tests.conftest import SF_MID, products_by_hand, rows

OPP_SCHEMA = ("order_id int, user_id int, eval_set string, order_number int, order_dow int, "
              "order_hour_of_day int, days_since_prior int, product_id int, add_to_cart_order int, "
              "reordered int")


def opp(spark, data):
    return spark.createDataFrame(data, OPP_SCHEMA)


def test_bool_flag_only_true_false_words(spark):
    df = spark.createDataFrame([(1, "true"), (2, "FALSE"), (3, "True"), (4, "1"), (5, "0"), (6, "t"),
                                (7, "yes"), (8, None), (9, " true")], "id int, reordered string")
    out = dict(fx.normalize_bool_flag(df).collect())
    assert out == {1: 1, 2: 0, 3: 1, 4: None, 5: None, 6: None, 7: None, 8: None, 9: None}


def test_bool_flag_accepts_real_booleans_and_moves_column_last(spark):
    df = spark.createDataFrame([(True, 1), (False, 2), (None, 3)], "reordered boolean, id int")
    out = fx.normalize_bool_flag(df)
    assert out.columns == ["id", "reordered"]
    assert dict(out.collect()) == {1: 1, 2: 0, 3: None}
    assert dict(out.dtypes)["reordered"] == "int"


def test_union_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(2, 1), (2, 1)], "y int, x int")
    assert rows(fx.order_products_union(a, b)) == [(1, 2), (1, 2), (1, 2)]


def test_order_products_prior_inner_join_and_column_order(spark):
    orders = spark.createDataFrame(
        [(1, 10, "prior", 1, 0, 0, None), (2, 10, "train", 2, 0, 0, 3), (3, 11, "prior", 1, 1, 1, None)],
        "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior int")
    op = spark.createDataFrame([(1, 100, 1, 0), (1, 100, 2, 1), (2, 100, 1, 1), (9, 5, 1, 0)],
                               "order_id int, product_id int, add_to_cart_order int, reordered int")
    out = fx.order_products_prior(orders, op)
    assert out.columns == ["order_id", "user_id", "eval_set", "order_number", "order_dow",
                           "order_hour_of_day", "days_since_prior", "product_id", "add_to_cart_order",
                           "reordered"]
    # train order 2 and orphan order 9 drop; order 3 has no basket rows; duplicates stay
    assert sorted(r.add_to_cart_order for r in out.collect()) == [1, 2]


def test_user_features_1_uses_all_orders_and_null_sums(spark):
    orders = spark.createDataFrame(
        [(1, 10, "prior", 1, None), (2, 10, "train", 2, None), (3, 11, "prior", 1, None),
         (4, 11, "test", 2, 5), (5, 11, "prior", 3, 6)],
        "order_id int, user_id int, eval_set string, order_number int, days_since_prior int")
    out = {r.user_id: r for r in fx.user_features_1(orders).collect()}
    assert out[10].max_order_num == 2 and out[10].sum_days_since_prior_order is None
    assert out[10].avg_days_since_prior_order is None
    assert out[11].sum_days_since_prior_order == 11 and out[11].avg_days_since_prior_order == 5.5
    assert dict(fx.user_features_1(orders).dtypes) == {
        "user_id": "int", "max_order_num": "int", "sum_days_since_prior_order": "bigint",
        "avg_days_since_prior_order": "double"}


def test_user_features_2_zero_denominator_is_null_and_ratio_can_exceed_one(spark):
    d = opp(spark, [
        # user 1: only first-order rows, one flagged reordered -> 1 / 0 -> NULL
        (1, 1, "prior", 1, 0, 0, None, 7, 1, 1),
        (1, 1, "prior", 1, 0, 0, None, 8, 2, 0),
        # user 2: dirty flags: 3 reorders (two in the first order), 2 repeat-order rows -> 1.5
        (2, 2, "prior", 1, 0, 0, None, 7, 1, 1),
        (2, 2, "prior", 1, 0, 0, None, 9, 2, 1),
        (3, 2, "prior", 2, 0, 0, 3, 7, 1, 1),
        (3, 2, "prior", 2, 0, 0, 3, None, 2, None),
    ])
    out = {r.user_id: r for r in fx.user_features_2(d).collect()}
    assert out[1].user_reorder_ratio is None
    assert out[1].total_number_products == 2 and out[1].total_number_distinct_products == 2
    assert out[2].user_reorder_ratio == 1.5
    # count(product_id) skips the NULL product, distinct count too
    assert out[2].total_number_products == 3 and out[2].total_number_distinct_products == 2


def test_prd_features_rank_counts_match_window_form(spark):
    d = opp(spark, [
        (1, 1, "prior", 1, 0, 0, None, 7, 1, 0),
        (2, 1, "prior", 2, 0, 0, 1, 7, 1, 1),
        (3, 1, "prior", 3, 0, 0, 1, 7, 1, 1),
        (4, 2, "prior", 1, 0, 0, None, 7, 1, 0),
        (4, 2, "prior", 1, 0, 0, None, 8, 2, None),
        (5, 3, "prior", 1, 0, 0, None, None, 1, 0),
        (6, 3, "prior", 2, 0, 0, 4, None, 1, 1),
    ])
    assert rows(fx.prd_features(d)) == products_by_hand(d)
    out = {r.product_id: r for r in fx.prd_features(d).collect()}
    assert (out[7].total_purchases, out[7].total_reorders, out[7].first_time_purchases,
            out[7].second_time_purchases) == (4, 2, 2, 1)


def test_prd_features_equals_a_count_by_hand_on_fixture(spark):
    o = R._opp(spark, SF_MID)
    assert rows(fx.prd_features(o)) == products_by_hand(o)


def test_metamorphic_sums(spark):
    o = R._opp(spark, SF_MID).cache()
    n_rows = o.count()
    n_pairs = o.select("user_id", "product_id").distinct().count()
    p = fx.prd_features(o).agg(F.sum("total_purchases"), F.sum("first_time_purchases")).first()
    assert p[0] == n_rows and p[1] == n_pairs
    up = fx.up_features(o).agg(F.sum("total_number_orders")).first()[0]
    assert up == n_rows
    o.unpersist()


def test_union_count_is_sum_of_counts(spark):
    from cartlake.sources import fixtures as fz
    prior = fz.order_products(spark, SF_MID, "prior")
    train = fz.order_products(spark, SF_MID, "train")
    assert fx.order_products_union(prior, train).count() == prior.count() + train.count()


def test_product_seq_time_tie_breakers(spark):
    d = opp(spark, [
        (5, 1, "prior", 2, 0, 0, 1, 7, 2, 1),
        (4, 1, "prior", 2, 0, 0, 1, 7, 1, 1),   # same order_number: order_id breaks the tie
        (3, 1, "prior", 1, 0, 0, None, 7, 1, 0),
    ])
    got = {r.order_id: r.product_seq_time for r in fx.product_seq_time(d).collect()}
    assert got == {3: 1, 4: 2, 5: 3}


def test_group_row_number_splits_hot_groups_exactly(spark):
    from pyspark.sql import Window
    from cartlake.operators.sequence import group_row_number
    n = 60000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise(F.col("id") % 500).cast("int").alias("u"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 11).cast("int").alias("p"),
        (F.col("id") * 7919 % 10007).cast("int").alias("o"), F.col("id").alias("tb"))
    got = group_row_number(df, ["u", "p"], ["o", "tb"], "rn", min_hot_rows=500)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("u", "p").orderBy("o", "tb")).cast("bigint"))
    assert dict(got.dtypes)["rn"] == "bigint"
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" in plan


def test_fully_tied_hot_group_is_split_into_even_ranges(spark):
    """All rows of the hot pair tie in the whole order, which starts with a string."""
    from cartlake.operators import sequence
    n = 40000
    df = spark.range(n).select(F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
                               F.lit("same").alias("o"), F.col("id").alias("x"))
    got = sequence.group_window(df, ["k"], ["o"], number="n", min_hot_rows=1000)
    hot = [r.n for r in got.filter("k = 'hot'").collect()]
    assert sorted(hot) == list(range(1, 30001)) and dict(got.dtypes)["n"] == "bigint"
    assert got.filter("k <> 'hot' AND n <> 1").isEmpty()
    sizes, rows_, _ = sequence._sizes_stats(df, ["k"], None)
    place = F.struct(F.col("o").alias("o0"), sequence._row_hash(df).alias("tie"))
    hot_rows = max(1000, rows_ // 8)
    cuts = sequence._splitters(df, ["k"], place, sizes.filter(F.col("__n") > hot_rows), hot_rows, None)
    ranges = [r["count"] for r in df.join(cuts, F.col("k") == F.col("__b_k")).groupBy(sequence._range_of(place)).count().collect()]
    assert len(ranges) == 6 and sum(ranges) == 30000 and max(ranges) < 2 * hot_rows


def test_range_of_equals_counting_on_long_splitter_lists(spark):
    from cartlake.operators import sequence
    cuts = [3 * i for i in range(1000)]
    df = spark.createDataFrame([(x, cuts[:n]) for x in (-1, 0, 1, 190, 191, 192, 193, 1500, 2997, 5000) for n in (1, 2, 63, 64, 65, 129, 1000)], "x int, __cuts array<int>")
    assert all(r.got == sum(c < r.x for c in r["__cuts"]) for r in df.withColumn("got", sequence._range_of(F.col("x"))).collect())


def test_without_hot_groups_no_side_table_is_built(spark):
    from cartlake.operators.sequence import group_window
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = group_window(df, ["k"], ["id"], number="n")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 1


def test_product_seq_time_salted_equals_plain_on_fixture(spark):
    o = R._opp(spark, SF_MID)
    salted = fx.product_seq_time(o, min_hot_rows=5)
    plain = fx.product_seq_time(o)
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_fixture_windows_salted_path_equals_plain(spark):
    """Force every customer / order into the hot path and compare with the plain plans."""
    from cartlake.operators import sequence
    from cartlake.sources import fixtures as fz
    sf = "/root/testdata/sf0.001"
    plain_o = fz.orders(spark, sf).collect()
    plain_op = fz.order_products_all(spark, sf).collect()
    old_min, old_p = sequence.MIN_HOT_ROWS, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        sequence.MIN_HOT_ROWS = 3
        spark.conf.set("spark.sql.shuffle.partitions", "1000")   # rows / P < 3: most groups are hot
        o = fz.orders(spark, sf)
        assert "__bucket" in o._jdf.queryExecution().executedPlan().toString()
        salted_o = o.collect()
        salted_op = fz.order_products_all(spark, sf).collect()
    finally:
        sequence.MIN_HOT_ROWS = old_min
        spark.conf.set("spark.sql.shuffle.partitions", old_p)
    assert sorted(plain_o, key=repr) == sorted(salted_o, key=repr)
    assert sorted(plain_op, key=repr) == sorted(salted_op, key=repr)


def test_group_window_lag_lead_across_buckets(spark):
    from pyspark.sql import Window
    from cartlake.operators.sequence import group_window
    df = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 300).cast("int").alias("k"),
        (F.col("id") * 7919 % 10007).cast("int").alias("o"), F.col("id").alias("tb"),
        (F.col("id") % 13).alias("x"))
    w = Window.partitionBy("k").orderBy("o", "tb")
    want = df.select("*", F.row_number().over(w).alias("rn"), F.lag("x").over(w).alias("px"),
                     F.lead("tb").over(w).alias("nt"))
    got = group_window(df, ["k"], ["o", "tb"], number="rn", lag={"x": "px"}, lead={"tb": "nt"},
                       min_hot_rows=100, buckets=7)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_empty_inputs_and_null_groups(spark):
    from cartlake.operators import changes as ch
    from cartlake.operators.sequence import group_window
    empty = opp(spark, [])
    for f in (fx.user_features_2, fx.up_features, fx.prd_features, fx.product_seq_time):
        assert f(empty).count() == 0
    assert group_window(empty, ["user_id"], ["order_number"], number="n", lag={"order_id": "p"}).count() == 0
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(ch.merge_upsert(t, t.limit(0), "k")) == [(1, "a")]
    # a NULL product is its own (user, product) group, as in the window form
    d = opp(spark, [(1, 1, "prior", 1, 0, 0, None, None, 1, 0), (2, 1, "prior", 2, 0, 0, 5, None, 1, 1)])
    assert rows(fx.prd_features(d)) == products_by_hand(d) == [(None, 2, 1, 1, 1)]


def test_group_window_hot_path_on_timestamps(spark):
    from pyspark.sql import Window
    from cartlake.operators.sequence import group_window
    df = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 200).cast("int").alias("k"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id * 7919) % 86400)")
         .alias("ts"),
        F.col("id").alias("tb"))
    w = Window.partitionBy("k").orderBy("ts", "tb")
    want = df.select("*", F.row_number().over(w).alias("rn"), F.lag("ts").over(w).alias("p"))
    got = group_window(df, ["k"], ["ts", "tb"], number="rn", lag={"ts": "p"}, min_hot_rows=100)
    assert "__bucket" in got._jdf.queryExecution().executedPlan().toString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_group_window_splits_a_hot_null_group(spark):
    from pyspark.sql import Window
    from cartlake.operators.sequence import group_window
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 50).cast("int").alias("k"),
        (F.col("id") * 31 % 997).cast("int").alias("o"), F.col("id").alias("tb"))
    got = group_window(df, ["k"], ["o", "tb"], number="n", min_hot_rows=100)
    w = Window.partitionBy("k").orderBy("o", "tb")
    want = df.withColumn("n", F.row_number().over(w))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # the NULL group (half of all rows) is the hot one and is split into several buckets
    from cartlake.operators import sequence
    sizes, _, _ = sequence._sizes_stats(df, ["k"], None)
    place = F.struct(F.col("o").alias("o0"), F.col("tb").alias("o1"), sequence._row_hash(df).alias("tie"))
    cuts = sequence._splitters(df, ["k"], place, sizes.filter("__n > 750"), 750, None).collect()
    assert len(cuts) == 1 and cuts[0]["__b_k"] is None and len(set(cuts[0]["__cuts"])) == 3


def test_group_window_hot_path_lead_only(spark):
    from pyspark.sql import Window
    from cartlake.operators.sequence import group_window
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 40).cast("int").alias("k"),
        (F.col("id") * 17 % 1013).cast("int").alias("o"), F.col("id").alias("tb"))
    w = Window.partitionBy("k").orderBy("o", "tb")
    want = df.withColumn("nxt", F.lead("tb").over(w))
    got = group_window(df, ["k"], ["o", "tb"], lead={"tb": "nxt"}, min_hot_rows=200, buckets=5)
    assert got.columns == ["k", "o", "tb", "nxt"]
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
