"""Plan checks on a Parquet long table: filters and column pruning reach the
scan, date joins are planned without a Python stage."""

from stationkit.config import DEFAULT as C
from stationkit.operators.clean import cutoff_filter
from stationkit.operators.joins import join_series
from stationkit.session import scratch_path
from stationkit.sources.fixtures import station_obs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _long_table(spark):
    path = scratch_path(spark, "obs-parquet")
    station_obs(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


def test_cutoff_and_series_filters_reach_the_scan(spark):
    obs = _long_table(spark)
    x = join_series(cutoff_filter(obs, "obs_date", "1996-05-01"), "series_id", "obs_date",
                    ["R", "N"], "inner", cols=["air_temp"])
    plan = _plan(x)
    pushed = [line.split("PushedFilters: ")[1] for line in plan.splitlines() if "PushedFilters" in line]
    assert len(pushed) == 2  # one scan per series slice, each filtered at the source
    for p in pushed:
        assert "GreaterThanOrEqual(obs_date,1996-05-01)" in p and "IsNotNull(series_id)" in p
        assert "EqualTo(seri" in p
    # only the needed columns are read
    assert "ReadSchema: struct<series_id:string,obs_date:date,air_temp:double>" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_supervised_table_is_python_free(spark):
    from stationkit.plans.supervised import supervised_table
    plan = _plan(supervised_table(_long_table(spark), C, mode="series"))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "Window" in plan


def test_bucketed_long_table_needs_no_shuffle_for_series_windows(spark):
    import uuid

    from stationkit.operators.shift import future_targets, ordering
    from stationkit.sources.stations import write_bucketed_long_table
    name = f"obs_long_{uuid.uuid4().hex[:8]}"
    t = write_bucketed_long_table(station_obs(spark, "/root/testdata/sf0.001", many=True), name,
                                  scratch_path(spark, name), 8)
    x = future_targets(t, C, ordering(C, mode="series"))
    plan = _plan(x)
    assert "Window" in plan and "Exchange" not in plan
    # same rows as the shuffled path over the unbucketed table
    y = future_targets(station_obs(spark, "/root/testdata/sf0.001", many=True), C, ordering(C, mode="series"))
    cols = sorted(x.columns)
    assert x.select(*cols).exceptAll(y.select(*cols)).count() == 0
    assert y.select(*cols).exceptAll(x.select(*cols)).count() == 0
