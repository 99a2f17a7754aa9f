from pyspark.sql import functions as F

from stationkit.operators.rows import (add_row_id, chronological_split, holdout_split, shuffled_order,
                                       stride_sample)


def _ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "row_id")


def test_holdout_sizes_like_scikit_learn(spark):
    out = holdout_split(_ids(spark, 11), "row_id", 0.2, seed=1)
    c = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert c == {"test": 3, "train": 8}


def test_holdout_exact_disjoint_and_seeded(spark):
    a = holdout_split(_ids(spark, 1000), "row_id", 0.3, seed=5, bits=4)
    b = holdout_split(_ids(spark, 1000), "row_id", 0.3, seed=5, bits=12)
    ta = {r.row_id for r in a.where("split = 'test'").collect()}
    tb = {r.row_id for r in b.where("split = 'test'").collect()}
    assert len(ta) == 300 and ta == tb
    c = holdout_split(_ids(spark, 1000), "row_id", 0.3, seed=6)
    assert {r.row_id for r in c.where("split = 'test'").collect()} != ta


def test_chronological_split(spark):
    out = chronological_split(_ids(spark, 11), "row_id", 0.8)
    assert [r.split for r in out.orderBy("row_id").collect()] == ["train"] * 8 + ["test"] * 3


def test_stride(spark):
    assert [r.row_id for r in stride_sample(_ids(spark, 257), "row_id", 128).orderBy("row_id").collect()] == [0, 128, 256]


def test_shuffle_is_a_permutation(spark):
    out = shuffled_order(_ids(spark, 500).withColumnRenamed("row_id", "k"), "k", 7, "row_id")
    rows = out.collect()
    assert sorted(r.row_id for r in rows) == list(range(500))
    assert [r.k for r in sorted(rows, key=lambda r: r.row_id)] != list(range(500))


def test_row_id_by_date(spark):
    df = spark.createDataFrame([(d,) for d in (5, 1, 3, 900, 2)], "d int") \
        .select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"))
    for kw in ({"chunk_days": 2, "mode": "chunked"}, {"max_rows_per_task": 2}, {}):
        out = add_row_id(df, ["obs_date"], **kw).orderBy("obs_date").collect()
        assert [r.row_id for r in out] == [0, 1, 2, 3, 4]
