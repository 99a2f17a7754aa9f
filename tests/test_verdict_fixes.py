"""Edge cases found in review: shared folder, station files, means, labels,
keys, correlations, predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationkit import session
from stationkit.config import Config


class _Cluster:
    """A session stand-in on a cluster master without a shared folder."""

    class _Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        def getCheckpointDir(self):
            return None

    sparkContext = _Context()
    conf = _Context()


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_Cluster())
    _Cluster._Context.master = "local-cluster[3,2,1024]"
    with pytest.raises(RuntimeError):
        session.shared_folder(_Cluster())


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", [])
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
    (_, path), = session._WRITTEN
    import os
    assert os.path.isdir(path.removeprefix("file:"))
    assert session.drop_written_tables(spark) == 1
    assert not os.path.exists(path.removeprefix("file:"))


def test_stored_tables_follow_their_input(spark, tmp_path):
    from stationkit.sources import fixtures
    sf = str(tmp_path)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(f"{sf}/events.parquet")
    spark.range(3).write.parquet(f"{sf}/events.parquet")
    assert fixtures.stored(spark, sf, "x", build).count() == 3
    assert fixtures.stored(spark, sf, "x", build).count() == 3 and len(built) == 1
    spark.range(7).write.mode("overwrite").parquet(f"{sf}/events.parquet")
    assert fixtures.stored(spark, sf, "x", build).count() == 7


def test_flat_station_files_with_their_own_headers(spark, tmp_path):
    from stationkit.sources.stations import read_station_files
    (tmp_path / "data_A.csv").write_text("DATE,  x,  y\n01.02.2000, 1, 2\n02.02.2000, -999, 4\n")
    (tmp_path / "data_B.csv").write_text("  DATE,y,x\n01.02.2000,2,1\n")
    (tmp_path / "data_C+1 d.csv").write_text("x,DATE,z\n5,03.02.2000,oops\n")
    out = read_station_files(spark, str(tmp_path), name_pattern=r"data_([^/]+)\.csv$")
    got = {(r["series_id"], str(r["obs_date"])): (r["x"], r["y"], r["z"]) for r in out.collect()}
    assert got == {("A", "2000-02-01"): (1.0, 2.0, None), ("A", "2000-02-02"): (-999.0, 4.0, None),
                   ("B", "2000-02-01"): (1.0, 2.0, None), ("C+1 d", "2000-02-03"): (5.0, None, None)}
    one = read_station_files(spark, str(tmp_path), series=["data_B"])
    assert [r["series_id"] for r in one.collect()] == ["data_B"]
    with pytest.raises(FileNotFoundError):
        read_station_files(spark, str(tmp_path), series=["nowhere"])


def test_mean_fill_of_the_network_study_leaves_sentinels_out(spark):
    from stationkit.plans.network import network_table
    cfg = Config(features=("air_temp", "precip"), targets=("air_temp",), series=("R",), target_series="R")
    rows = [("R", d, None if d == 3 else -999.0 if d == 7 else float(d), 1.0) for d in range(20)]
    df = spark.createDataFrame(rows, "series_id string, d int, air_temp double, precip double").select(
        "series_id", F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"), "air_temp", "precip")
    got = [r["R_air_temp"] for r in network_table(df, cfg).orderBy("row_id").collect()]
    mean = (sum(range(20)) - 10) / 18
    assert got[3] == pytest.approx(mean) and got[7] == pytest.approx(mean) and got[4] == 4.0


def test_goal_labels_of_series_with_underscores(spark):
    from stationkit.operators.stats import goal_series_long
    df = spark.createDataFrame([(1, 2.0)], "d int, `St_A_air_temp_future_1Day` double")
    r = goal_series_long(df, "d", ["St_A_air_temp_future_1Day"]).first()
    assert (r["target"], r["horizon"]) == ("air_temp", 1)


def test_holdout_on_text_keys_and_one_hash_value(spark, monkeypatch):
    from stationkit.operators import rows as RW
    df = spark.range(200).select(F.concat(F.lit("k"), "id").alias("key"))
    out = RW.holdout_split(df, "key", 0.25, seed=3)
    assert out.where("split = 'test'").count() == 50
    monkeypatch.setattr(RW, "hash32", lambda seed, key: F.lit(7).cast("bigint"))
    same = RW.holdout_split(df, "key", 0.25, seed=3)
    assert sorted(r["key"] for r in same.where("split = 'test'").collect()) == sorted(
        r["key"] for r in df.collect())[:50]


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e9])
def test_correlation_keeps_its_digits(spark, offset):
    from stationkit.operators.stats import corr_long
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2))
    x[:, 1] += x[:, 0]
    want = np.corrcoef(x.T)[0, 1]
    x = x + offset
    rows = [tuple(map(float, r)) for r in x]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in corr_long(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(want, abs=1e-6 if offset > 1e8 else 1e-9)
    assert got["a", "a"] == pytest.approx(1.0, abs=1e-12) and got["a", "a"] <= 1.0


def test_correlation_with_one_value_far_below(spark):
    from stationkit.operators.stats import corr_long
    rng = np.random.default_rng(4)
    v = np.append(1e6 + rng.normal(size=300), 0.0)
    df = spark.createDataFrame([(float(a),) for a in v], "a double")
    r = corr_long(df, ["a"]).first()
    assert r["corr"] <= 1.0 and r["corr"] == pytest.approx(1.0, abs=1e-12)


def test_several_models_may_share_a_goal(spark):
    from stationkit.operators import linear as LN
    from stationkit.operators import models as MD
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 2))
    y = 1 + x @ [2.0, -1.0]
    df = spark.createDataFrame([(i, "train" if i % 4 else "test", float(a), float(b), float(c))
                                for i, ((a, b), c) in enumerate(zip(x, y))],
                               "id int, split string, a double, b double, y double")
    out = MD.fit_family(df, "split", ["a", "b"], {"m1": "y", "m2": "y"}, "ols")
    assert out.count() == 4
    models = LN.ols_models(df, ["a", "b"], {"m1": "y", "m2": "y"}, fit_filter=F.col("split") == "train")
    rows = LN.predict_all(df, models, ["a", "b"], {"m1": "y", "m2": "y"}, ["id"]).collect()
    assert len(rows) == 160 and all(abs(r["p"] - r["y"]) < 1e-9 for r in rows)


def test_supervised_table_has_one_window_pass_and_no_join(spark):
    from stationkit.plans.supervised import supervised_table
    from stationkit.session import scratch_path
    from stationkit.sources.fixtures import station_obs
    path = scratch_path(spark, "obs-12")
    names = [str(i) for i in range(1, 13)]
    station_obs(spark, "/root/testdata/sf0.001", many=True).write.parquet(path)
    cfg = Config(series=tuple(names), target_series="1")
    plan = supervised_table(spark.read.parquet(path), cfg, mode="series")._jdf.queryExecution().executedPlan().toString()
    nodes = [line.strip(" +-:*()0123456789") for line in plan.splitlines()]
    assert sum(n.startswith("FileScan") for n in nodes) == 1
    assert not any("Join" in n.split(" ")[0] for n in nodes)
    assert sum(n.startswith("Window") for n in nodes) <= 3
