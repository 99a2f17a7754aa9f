import random

import pytest
from pyspark.sql import functions as F

from conftest import series_df
from stationkit.operators.impute import interpolate_linear
from stationkit.operators.series_window import Ordering, shift_rows, with_position


def _o(mode, chunk_days=3):
    return Ordering(partition=("series_id",), order=("obs_date",), chunk_days=chunk_days, mode=mode)


def _vals(df, col="v"):
    return [r[col] for r in df.orderBy("series_id", "obs_date").collect()]


@pytest.mark.parametrize("mode", ["series", "chunked"])
def test_interpolation_gaps_at_both_ends(spark, mode):
    vals = [None, 1.0, None, None, 4.0, None]
    df = series_df(spark, [("s", i, v) for i, v in enumerate(vals)])
    assert _vals(interpolate_linear(df, ["v"], _o(mode))) == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


@pytest.mark.parametrize("mode", ["series", "chunked"])
def test_interpolation_all_missing_and_single(spark, mode):
    df = series_df(spark, [("a", 0, None), ("a", 1, None), ("b", 0, None), ("b", 1, 5.0), ("b", 2, None)])
    out = interpolate_linear(df, ["v"], _o(mode))
    assert _vals(out) == [None, None, None, 5.0, 5.0]


@pytest.mark.parametrize("mode", ["series", "chunked"])
def test_row_shift_over_calendar_hole_and_series_boundary(spark, mode):
    df = series_df(spark, [("a", 1, 1.0), ("a", 2, 2.0), ("a", 5, 5.0), ("b", 1, 10.0)])
    out = shift_rows(df, [("nxt", "v", 1), ("prv", "v", -1)], _o(mode)).orderBy("series_id", "obs_date")
    rows = [(r.v, r.nxt, r.prv) for r in out.collect()]
    assert rows == [(1.0, 2.0, None), (2.0, 5.0, 1.0), (5.0, None, 2.0), (10.0, None, None)]


def test_chunked_equals_series_on_random_data(spark):
    rnd = random.Random(7)
    rows = []
    for s in ("a", "b", "c"):
        day = 0
        for _ in range(120):
            day += rnd.choice([1, 1, 1, 2, 5])
            rows.append((s, day, None if rnd.random() < 0.3 else rnd.uniform(-5, 5)))
    df = series_df(spark, rows)
    specs = [(f"l{k}", "v", k) for k in (1, 2, 3, 7)] + [(f"g{k}", "v", -k) for k in (1, 4)]
    a = interpolate_linear(shift_rows(df, specs, _o("series")), ["v"], _o("series"))
    b = interpolate_linear(shift_rows(df, specs, _o("chunked", 4)), ["v"], _o("chunked", 4))
    cols = ["series_id", "obs_date", "v"] + [s[0] for s in specs]
    ra = [tuple(r) for r in a.select(*cols).orderBy("series_id", "obs_date").collect()]
    rb = [tuple(r) for r in b.select(*cols).orderBy("series_id", "obs_date").collect()]
    assert len(ra) == 360
    for x, y in zip(ra, rb):
        for u, w in zip(x, y):
            assert (u is None and w is None) or u == pytest.approx(w)


def test_global_position_is_dense(spark):
    df = series_df(spark, [("x", d, float(d)) for d in range(0, 500, 3)])
    o = Ordering(partition=(), order=("obs_date",), chunk_days=7, mode="chunked")
    pos = [r.row_pos for r in with_position(df, o).orderBy("obs_date").collect()]
    assert pos == list(range(len(pos)))


def test_auto_sizes_chunks_for_a_hot_series(spark):
    """One series with most rows, sub-daily timestamps: auto picks the chunked
    path with sub-day chunks, and the results equal the one-task path."""
    from pyspark.sql import functions as F
    from stationkit.operators.series_window import resolve
    rnd = random.Random(11)
    rows = [("hot" if i % 3 else f"u{i % 50}", 1_700_000_000 + i * 37 + rnd.randint(0, 30), i,
             None if i % 7 == 0 else float(i % 13)) for i in range(3000)]
    df = spark.createDataFrame(rows, "series_id string, t long, event_id long, value double") \
        .select("series_id", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), "event_id", "value")
    auto = Ordering(partition=("series_id",), order=("ts", "event_id"), max_rows_per_task=200)
    r = resolve(df, auto)
    assert r.mode == "chunked" and r.chunk_micros < 86_400_000_000
    one = Ordering(partition=("series_id",), order=("ts", "event_id"), mode="series")
    specs = [("n1", "value", 1), ("n3", "value", 3), ("p2", "value", -2)]
    a = interpolate_linear(shift_rows(df, specs, auto), ["value"], auto)
    b = interpolate_linear(shift_rows(df, specs, one), ["value"], one)
    cols = ["series_id", "event_id", "value", "n1", "n3", "p2"]
    ra = sorted(tuple(x) for x in a.select(*cols).collect())
    rb = sorted(tuple(x) for x in b.select(*cols).collect())
    assert ra == rb


def test_gap_spanning_several_chunks_and_duplicate_dates(spark):
    """A missing run crossing several 3-day chunks is interpolated from values
    chunks away; rows sharing a date get a fixed order from the tiebreak."""
    vals = [1.0] + [None] * 20 + [22.0, None, None]
    rows = [("s", i, v) for i, v in enumerate(vals)]
    df = series_df(spark, rows)
    out = _vals(interpolate_linear(df, ["v"], _o("chunked", 3)))
    assert out == pytest.approx([float(i + 1) for i in range(22)] + [22.0, 22.0])
    dup = series_df(spark, [("s", 0, 3.0), ("s", 0, 1.0), ("s", 1, 2.0)])
    o = Ordering(partition=("series_id",), order=("obs_date", "v"), chunk_days=1, mode="chunked")
    got = [(r.v, r.nxt) for r in shift_rows(dup, [("nxt", "v", 1)], o).orderBy("obs_date", "v").collect()]
    assert got == [(1.0, 3.0), (3.0, 2.0), (2.0, None)]


def _awkward(spark):
    """Null series, null dates, a burst on one date, one row far away, and
    column names that look like helper columns."""
    rows = [("a", d, i, None if i % 3 == 0 else float(i)) for i, d in enumerate([0, 0, 0, 0, 0, 0, 1, 2, 4000])]
    rows += [(None, d, 100 + i, float(i)) for i, d in enumerate([5, 6, None, 9])]
    rows += [("b", None, 200, None), ("b", None, 201, 7.0), ("b", 3, 202, None)]
    df = spark.createDataFrame(rows, "series_id string, d int, id long, v double")
    return df.select("series_id", F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"),
                     "id", "v", F.col("id").alias("my__col"), F.col("id").alias("_sk_part"))


@pytest.mark.parametrize("how", [{"mode": "chunked", "chunk_days": 2}, {"mode": "auto", "max_rows_per_task": 4},
                                 {"mode": "chunked", "chunk_rows": 2}])
@pytest.mark.parametrize("partition", [("series_id",), ()])
@pytest.mark.parametrize("nulls", [True, False])
def test_both_modes_agree_on_awkward_keys(spark, how, partition, nulls):
    from stationkit.operators.series_window import neighbours
    from stationkit.operators.shift import tail_trim
    df = _awkward(spark)
    if not nulls:
        df = df.where("series_id is not null and obs_date is not null")
    order = ("obs_date", "id") if partition else ("obs_date", "series_id", "id")
    one = Ordering(partition=partition, order=order, mode="series")
    cut = Ordering(partition=partition, order=order, **how)
    specs = [("n1", "v", 1), ("n5", "id", 5), ("p2", "v", -2), ("s1", "series_id", 1)]
    for op in (lambda x, o: with_position(x, o), lambda x, o: shift_rows(x, specs, o),
               lambda x, o: neighbours(x, ["v"], o), lambda x, o: tail_trim(x, 2, o),
               lambda x, o: interpolate_linear(x, ["v"], o)):
        a, b = op(df, one), op(df, cut)
        assert a.columns == b.columns and a.dtypes == b.dtypes
        ra, rb = ({r["id"]: tuple(r) for r in x.collect()} for x in (a, b))
        assert len(ra) == len(rb) and ra == rb


def test_chunks_are_even_for_a_burst(spark):
    """Ten thousand rows on one date and one row far away: chunks follow the rows."""
    from stationkit.operators.series_window import _chunked_base, resolve
    df = spark.range(10_000).select(F.lit("s").alias("series_id"), F.when(F.col("id") == 9_999, 9_000_000)
                                    .otherwise(0).alias("t"), "id")
    o = resolve(df, Ordering(partition=("series_id",), order=("t", "id"), max_rows_per_task=2000))
    assert o.chunk_rows == 1000  # one width would leave 9,999 rows in a chunk
    m, _, nm = _chunked_base(df, o)
    sizes = [r["count"] for r in m.groupBy(nm.chunk).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 2500
