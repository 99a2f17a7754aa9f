from stationkit.config import DEFAULT as C
from stationkit.plans.jobs import linear_study, preparation_job
from stationkit.session import scratch_path
from stationkit.sources.fixtures import station_obs
from stationkit.sources.stations import write_station_files


def test_preparation_and_linear_study_end_to_end(spark):
    src = scratch_path(spark, "stations")
    write_station_files(station_obs(spark, "/root/testdata/sf0.001"), src)
    out = scratch_path(spark, "prepared")
    paths = preparation_job(spark, src, out, C)
    feats = spark.read.parquet(paths["sorted"]["features"])
    goals = spark.read.parquet(paths["shuffled"]["goals"])
    assert feats.count() == 182 and goals.count() == 182  # the flagship's row count
    assert len(feats.columns) == 1 + 15 and len(goals.columns) == 1 + 6
    study = linear_study(spark, paths["sorted"], C, scratch_path(spark, "study"))
    assert study.sweep.count() == 300
    assert study.summary.count() == 10
    assert study.best.count() == 1
    assert study.models.count() == 6 * 16
    assert study.metrics.count() == 12


def test_statistics_report_and_network_study(spark):
    from stationkit.plans.jobs import network_study, statistics_report
    src = scratch_path(spark, "stations")
    write_station_files(station_obs(spark, "/root/testdata/sf0.001"), src)
    paths = preparation_job(spark, src, scratch_path(spark, "prepared"), C)
    rep = statistics_report(spark, paths["shuffled"], C)
    assert rep.goal_series.count() == 182 * 6
    assert rep.corr_to_goals.count() == 21 * 6
    assert rep.histograms.count() == 200
    nn = network_study(spark, src, C)
    assert nn.metrics.count() == 6
    n = nn.table.count()
    assert nn.scores.count() == n and set(nn.scores.columns) >= {"pred_day1", "date_day3"}
