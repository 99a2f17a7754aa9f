from pyspark.sql import functions as F

from stationkit.operators.clean import sentinel_to_null
from stationkit.session import scratch_path
from stationkit.sources.stations import write_station_files
from stationkit.streaming.ingest import ingest


def test_stream_ingest_equals_batch(spark):
    df = spark.createDataFrame(
        [("A", "2001-01-01", -999.0, 1.0), ("A", "2001-01-02", 2.0, 3.0), ("B", "2001-01-01", 5.0, -999.0)],
        "series_id string, d string, air_temp double, precip double") \
        .select("series_id", F.col("d").cast("date").alias("obs_date"), "air_temp", "precip")
    src, dst, ck = (scratch_path(spark, x) for x in ("src", "dst", "ck"))
    write_station_files(df, src)
    q = ingest(spark, src, dst, ck, ["air_temp", "precip"])
    q.awaitTermination(120)
    got = spark.read.parquet(dst).select("series_id", "obs_date", "air_temp", "precip")
    want = sentinel_to_null(df, ["air_temp", "precip"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stream_restart_adds_nothing_and_picks_up_new_files(spark):
    df = spark.createDataFrame([("A", "2001-01-01", 1.0, 1.0)], "series_id string, d string, air_temp double, precip double") \
        .select("series_id", F.col("d").cast("date").alias("obs_date"), "air_temp", "precip")
    src, dst, ck = (scratch_path(spark, x) for x in ("src", "dst", "ck"))
    write_station_files(df, src + "/batch1")
    ingest(spark, src, dst, ck, ["air_temp", "precip"]).awaitTermination(120)
    ingest(spark, src, dst, ck, ["air_temp", "precip"]).awaitTermination(120)  # restart, nothing new
    assert spark.read.parquet(dst).count() == 1
    more = df.withColumn("obs_date", F.date_add("obs_date", 1))
    write_station_files(more, src + "/batch2")
    ingest(spark, src, dst, ck, ["air_temp", "precip"]).awaitTermination(120)
    assert spark.read.parquet(dst).count() == 2
