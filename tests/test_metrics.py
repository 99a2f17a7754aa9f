import pytest

from stationkit.operators.metrics import penalised_mse, regression_metrics


def test_negative_r2(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], "y double, p double")
    r = regression_metrics(df, [], "y", "p").collect()[0]
    assert r.r2 == pytest.approx(-3.0) and r.mse == pytest.approx(8 / 3)


def test_penalty_on_negative_prediction(spark):
    df = spark.createDataFrame([(1.0, -1.0)], "y double, p double")
    assert penalised_mse(df, [], "y", "p").collect()[0].penalised_mse == 40.0
