import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stationkit.session import local_session
    s = local_session(4, shuffle_partitions=4, app="stationkit-tests", memory="4g")
    yield s
    s.stop()


def series_df(spark, rows, cols=("v",)):
    """rows: list of (series_id, day_number, *values) -> DataFrame with DATE."""
    from pyspark.sql import functions as F
    schema = "series_id string, d int, " + ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame(rows, schema)
    return df.select("series_id", F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")).alias("obs_date"),
                     *cols)
