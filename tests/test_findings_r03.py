"""Findings of round 3, on rows built here."""
import datetime as dt
import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stationkit.llm import langid, sentencepieces
from stationkit.operators import pair_tiles as PT
from stationkit.operators import radix as RX
from stationkit.operators import series_window as SW


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    """A folder with a few line items."""
    folder = tmp_path_factory.mktemp("tables")
    rows = [(1000 * i + j, 1 + j, flag, dt.date(1995, 2, 1) + dt.timedelta(days=i), 1.0 + (7 * i + 3 * j) % 11, 0.01 * (i % 9),
             0.01 * (j % 5), 1 + (i + j) % 4) for i in range(150) for j, flag in enumerate("NARNAR")]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_returnflag string, l_shipdate date, l_quantity double, "
                                "l_discount double, l_tax double, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_chronological_split_keeps_every_rows_position(spark, small_tables):
    got = E.queries()["chronological_split"](spark, small_tables)
    assert got.columns == ["row_id", "obs_date", "split"]
    rows = sorted(got.collect())
    assert len(rows) > 20 and [r.row_id for r in rows] == list(range(len(rows)))
    assert [r.obs_date for r in rows] == sorted(r.obs_date for r in rows)
    assert [r.split for r in rows] == ["train"] * int(0.8 * len(rows)) + ["test"] * (len(rows) - int(0.8 * len(rows)))


# ------------------------------------------------------------------ pair tiles (F1, F2)

def series_cells(columns, days, copies=1):
    rnd = random.Random(8)
    own = {c: [(d, round(rnd.gauss(0, 1) + d % 7, 2)) for d in range(days) if rnd.random() < 0.7] for c in range(columns)}
    return [(d, f"s{c}_{i}", v) for c, cells in own.items() for i in range(copies) for d, v in cells]


@pytest.mark.parametrize("block,cells", [(3, 10_000), (2048, 60), (2, 6)])
def test_corr_tiles_by_packed_blocks_of_any_size(spark, block, cells):
    rows = series_cells(9, 30)
    got = PT.corr_tiles(spark.createDataFrame(rows, "d long, s string, v double"), "d", "s", "v", block, cells).collect()
    wide = pd.DataFrame(rows, columns=["d", "s", "v"]).pivot(index="d", columns="s", values="v")
    want = wide.corr()
    assert len(got) == 45 and all(r.col_a <= r.col_b for r in got)
    for r in got:
        assert r.corr == pytest.approx(want.loc[r.col_a, r.col_b], abs=1e-9)
        assert r.n_pairs == int((wide[r.col_a].notna() & wide[r.col_b].notna()).sum())


def test_corr_tiles_copy_no_value_for_each_tile(spark):
    df = spark.createDataFrame(series_cells(9, 30), "d long, s string, v double")
    found = PT.corr_tiles(df, "d", "s", "v", 2, 10_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan and "CoGroup" not in plan


def test_nearest_by_tiles_is_nearest_of_all_pairs(spark):
    df = spark.createDataFrame(series_cells(6, 40, copies=4) + [(d, "flat", 1.0) for d in range(40)], "d long, s string, v double")
    want = sorted(PT.nearest_columns(PT.corr_tiles(df, "d", "s", "v"), 2, 10).collect())
    for blocks in ({}, {"block_columns": 4}, {"block_columns": 2, "cells": 8}):
        assert sorted(PT.nearest_by_tiles(df, "d", "s", "v", 2, 10, **blocks).collect()) == want
    assert len(want) == 24 and all(r.near1[:2] == r.col[:2] and r.near1 < r.near2 for r in want)


@pytest.mark.parametrize("best", [None, (2, 5, 9)])
def test_parts_of_a_tile_make_the_whole_tile(monkeypatch, best):
    def table(block, columns):
        cells = [(0, block, f"d{d:02}", c[:1] * block + c, v) for d, c, v in series_cells(columns, 30)]
        return PT._pack(pa.table(list(zip(*cells)), ["rows", "block", "key", "col", "v"])).to_batches()[0]

    def paired(a, b):
        return pa.RecordBatch.from_arrays([*a.columns, *b.columns], [f"{s}_{n}" for s in "ab" for n in a.schema.names])

    def found(batch):
        pairs = {}
        for out in PT._sums_of(best)([batch]):
            for r in out.to_pylist():
                assert (r["col_a"], r["col_b"]) not in pairs
                pairs[r["col_a"], r["col_b"]] = list(r.values())[2:]
        return pairs

    one, other = table(0, 7), table(1, 5)
    for batch in (paired(one, one), paired(one, other)):
        whole = found(batch)
        monkeypatch.setattr(PT, "COLUMNS", 3)
        monkeypatch.setattr(PT, "KEYS", 7)
        parts = found(batch)
        monkeypatch.undo()
        assert whole and whole.keys() <= parts.keys() and (best or whole.keys() == parts.keys())
        assert all(parts[k] == pytest.approx(whole[k], abs=1e-9) for k in whole)


def test_a_tile_hands_on_its_best_pairs_only():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(50, 40))
    ones = np.ones_like(x)
    sums = np.stack([ones.T @ ones, x.T @ ones, ones.T @ x, (x * x).T @ ones, ones.T @ (x * x), x.T @ x])
    kept = PT._may_be_best(sums, ~np.eye(40, dtype=bool), 2, 10, 9)
    assert kept.sum() <= 4 * 40 and (kept.sum(0) >= 2).all() and (kept.sum(1) >= 2).all()
    assert PT._rounded(np.array([[0.1234567895, -0.1234567895, 0.12345678949]]), 9).tolist() == [[123456790.0, -123456790.0, 123456789.0]]


# ------------------------------------------------------------------ chunks

def test_tasks_of_a_range_partitioning_do_not_grow_with_the_chunks(spark, monkeypatch):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("s"),
                                  F.when(F.col("id") % 5 > 0, F.lit(7)).otherwise(F.col("id")).alias("t"), "id")
    o = SW.Ordering(("s",), ("t", "id"), mode="chunked", chunk_rows=10)
    m, offs, nm = SW._chunked_base(df, o)
    few = 4 * spark.sparkContext.defaultParallelism
    assert SW._range_partitions(df, 4000, 400) == few and SW._range_partitions(df, 4000, 3) == 3
    assert SW._range_partitions(df, 10 ** 10, 10 ** 7) == 5000
    sizes = [r[0] for r in m.groupBy(nm.chunk).count().select("count").collect()]
    assert max(sizes) <= 10 and len(sizes) > 300 and sum(sizes) == 4000
    assert m.select(F.shiftright(nm.chunk, 33).alias("p")).distinct().count() <= few
    got = SW.with_position(SW.shift_rows(df, [("next", "id", 1)], o), o, "place").collect()
    want = {}
    for r in df.collect():
        want.setdefault(r.s, []).append((r.t, r.id))
    for rows in want.values():
        rows.sort()
    assert len(got) == 4000
    for r in got:
        rows = want[r.s]
        assert rows[r.place] == (r.t, r.id)
        assert r.next == (rows[r.place + 1][1] if r.place + 1 < len(rows) else None)


# ------------------------------------------------------------------ quantiles

@pytest.mark.parametrize("sorted_rows", [0, 12, 1_000_000])
def test_quantiles_by_sorting_equal_those_by_radix(spark, sorted_rows):
    rnd = random.Random(4)
    odd = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -2.5]
    rows = [(None if g == 3 else g, rnd.choice([*odd, None, rnd.gauss(0, 1e3)])) for g in range(9) for _ in range(1 + 4 * g)]
    df = spark.createDataFrame(rows, "g int, v double")
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r.g, r.q): r.value for r in RX.exact_quantiles(df, "v", qs, ["g"], sorted_rows).collect()}
    groups = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    assert got.keys() == {(g, q) for g in groups for q in qs}
    for (g, q), value in got.items():
        v = sorted(groups[g])
        at = q * (len(v) - 1)
        lo, hi = v[math.floor(at)], v[math.ceil(at)]
        want = lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))
        assert value == want or (math.isnan(value) and math.isnan(want)), (g, q)


def test_quantiles_of_small_groups_take_one_shuffle_of_the_rows(spark):
    df = spark.range(300).select((F.col("id") % 7).alias("g"), F.rand(3).alias("v"))
    plan = RX.exact_quantiles(df, "v", [0.1, 0.9], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1 and "Join" not in plan


# ------------------------------------------------------------------ pipeline's driver memory, op12's time

def test_language_training_brings_the_model_alone_to_the_driver(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, " ".join("".join(rnd.choices("aeioust" if i % 2 else "bcdfgaz", k=6)) for _ in range(30)), "xy"[i % 2])
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    expected = langid._fit([tuple(r) for r in langid._sample(docs, 80, 8000)], 8, 1.0, 0.001, 9)
    came, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: [came.append(r) or r for r in collect(df)])
    model = langid.train(docs, per_lang=80)
    assert len(came) <= 4  # the languages' counts and the model
    assert model.languages == ["x", "y"] and np.allclose(model.table, expected.table, atol=1e-4)
    assert np.isclose(model.threshold, expected.threshold) and np.isclose(model.temperature, expected.temperature)


def test_texts_of_many_id_arrays_are_decoded_at_once():
    own = sentencepieces.Vocabulary(sentencepieces.default_model())
    rnd = random.Random(5)
    odd = [0, *own.bytes_of.values(), own.numbers["\u2581"], own.numbers["\u2581the"]]
    many = [[rnd.choice([rnd.choice(odd), rnd.randrange(3, own.size)]) for _ in range(rnd.randrange(6))] for _ in range(2000)]
    for some in (many, many[:3] + [[1, 300, 2]], [[]], []):  # with and without control pieces
        assert own.decode_all([np.array(ids, "<i4") for ids in some]) == [own.library.decode(ids) for ids in some]


class CountedLookups(dict):
    lookups = 0

    def get(self, *key):
        self.lookups += 1
        return super().get(*key)

    def __getitem__(self, key):
        self.lookups += 1
        return super().__getitem__(key)


def test_each_different_stretch_of_a_slice_is_looked_up_once():
    own = sentencepieces.Vocabulary(sentencepieces.default_model())
    own.known = CountedLookups()
    texts = ["one two three " * 500, "three two", "", "日 one"] * 20
    for _ in range(2):  # not known, known
        own.known.lookups = 0
        assert [ids.tolist() for ids in own.encode_all(texts)] == own.library.encode(texts)
        assert own.known.lookups < 20


def test_texts_are_cut_as_the_rules_say():
    own = sentencepieces.Vocabulary(sentencepieces.default_model())
    inner = {c for n in own.numbers if len(n) > 1 for c in n} - {"▁"}
    rnd = random.Random(6)
    some = ["▁", "a", "b", "é", "\0", "�", "\U0001F600", "\U0010FFFF", "日"]
    assert {c in inner for c in some} == {False, True}
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randrange(12))) for _ in range(500)] + [""]
    spaces_or_words = re.compile("▁*[" + "".join(map(re.escape, sorted(inner))) + "]+|▁+|.", re.DOTALL)
    cut, ends = own._cut(texts)
    cut.validate(full=True)
    assert [cut[a:b].to_pylist() for a, b in zip(ends.tolist(), ends[1:].tolist())] == [
        spaces_or_words.findall(t) for t in texts]
    assert own._cut(["", ""])[0].to_pylist() == []
    own.kind_of[ord("▁")] = sentencepieces._INNER  # as if pieces held it behind other characters
    assert own._cut(["a▁b\0▁"])[0].to_pylist() == ["a▁b", "\0", "▁"]


def test_joins_are_found_in_the_table():
    own = sentencepieces.Vocabulary(sentencepieces.default_model())
    names = list(own.numbers)
    rnd = random.Random(7)
    pairs = [(n[:k], n[k:]) for n in rnd.sample(names, 2000) for k in range(1, len(n))] + [
        (rnd.choice(names), rnd.choice(names)) for _ in range(2000)]
    pairs = [(a, b) for a, b in pairs if a in own.numbers and b in own.numbers]
    got = own._joins(*np.array([[own.numbers[a], own.numbers[b]] for a, b in pairs]).T)
    assert got.tolist() == [own.ranks[a + b] + own.numbers[a + b] if a + b in own.numbers else sentencepieces._NEVER
                            for a, b in pairs]
    assert (own._joins(np.full(3, own.base - 1), np.array([5, own.size, own.base - 1])) == sentencepieces._NEVER).all()
