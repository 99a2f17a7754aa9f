import numpy as np

from stationkit.config import DENSE_LAYERS
from stationkit.operators.models import dense_forward, dense_score, dense_weights, poly_terms
from stationkit.session import scratch_path
from stationkit.sources.stations import read_station_files, write_station_files


def test_dense_score_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame([(i, *map(float, x[i])) for i in range(50)], "id long, a double, b double, c double, d double")
    w = dense_weights(4, DENSE_LAYERS, seed=0)
    out = dense_score(df, ["a", "b", "c", "d"], ["id"], w, ["o1", "o2", "o3"]).orderBy("id").collect()
    ref = dense_forward(x, w)
    assert np.allclose([[r.o1, r.o2, r.o3] for r in out], ref)


def test_poly_terms_count_and_order(spark):
    names = [n for n, _ in poly_terms([f"f{i}" for i in range(15)], 2)]
    assert len(names) == 136 and names[:3] == ["t_bias", "t_0", "t_1"] and names[16] == "t_0_0"
    assert len(poly_terms([f"f{i}" for i in range(15)], 3)) == 816


def test_station_files_round_trip(spark):
    df = spark.createDataFrame([("Hill", "2001-02-03", -999.0, 1.5), ("Valley", "2001-02-04", 2.0, 3.0)],
                               "series_id string, obs_date string, air_temp double, precip double") \
        .selectExpr("series_id", "CAST(obs_date AS DATE) AS obs_date", "air_temp", "precip")
    path = scratch_path(spark, "test-stations")
    write_station_files(df, path)
    header = open([p for p in __import__("glob").glob(f"{path}/series_id=Hill/*.csv")][0]).readline()
    assert header.startswith("  DATE,  air_temp")  # padded names, as in the station files
    back = read_station_files(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_station_files_read_only_requested_stations(spark):
    import glob

    from pyspark.sql import functions as F
    df = spark.createDataFrame([(s, "2001-02-03", 1.0) for s in ("S1", "S2", "S3")],
                               "series_id string, obs_date string, air_temp double") \
        .withColumn("obs_date", F.col("obs_date").cast("date"))
    path = scratch_path(spark, "test-stations-subset")
    write_station_files(df, path)
    back = read_station_files(spark, path, series=["S1", "S3"])
    files = {f.split("/")[-2] for f in back.inputFiles()}
    assert files == {"series_id=S1", "series_id=S3"}
    assert sorted(r.series_id for r in back.collect()) == ["S1", "S3"]
    assert len(glob.glob(f"{path}/series_id=*")) == 3
