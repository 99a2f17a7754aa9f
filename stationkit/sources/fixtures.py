"""Station-series stand-in derived from the driver's ``lineitem`` table.

The driver tables hold no weather stations, so a daily long table with
planted sentinels is derived in SQL.  The same text runs in Spark SQL and in
DuckDB, which lets every query start from identical input on both sides.
``l_returnflag`` (A, N, R) plays three stations, R is the target; the
many-series variant uses ``l_suppkey``.

Every ``lineitem`` row is aggregated into the daily table.  The modulo
expressions on the day number plant the -999 sentinels (isolated, in runs, at
both ends); no row is left out.  Calendar gaps, by which row shifts
differ from date shifts, come from moving dates apart at the three stations;
the suppliers' series have gaps of their own.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def _base_cte(station_expr: str, date_expr: str) -> str:
    return f"""base AS (
  SELECT {station_expr} AS station, {date_expr} AS obs_date,
    CAST(SUM(l_quantity) AS DOUBLE)/COUNT(*)                         AS air_temp,
    CAST(SUM(CAST(ROUND(l_discount*100) AS BIGINT)) AS DOUBLE)       AS precip,
    CAST(SUM(CAST(ROUND(l_tax*100) AS BIGINT)) AS DOUBLE)            AS vapor_pressure,
    CAST(COUNT(*) % 4 AS DOUBLE)                                     AS precip_kind,
    CAST(MAX(l_linenumber) AS DOUBLE)                                AS snow_depth,
    YEAR(CAST(MIN(l_shipdate) AS DATE))*372 + MONTH(CAST(MIN(l_shipdate) AS DATE))*31
      + DAY(CAST(MIN(l_shipdate) AS DATE))                           AS k
  FROM lineitem GROUP BY {station_expr}, {date_expr})"""


_OBS_SELECT = """obs AS (
SELECT station AS series_id, obs_date,
  CASE WHEN k % 17 IN (3,4,5) OR obs_date <= DATE '1995-01-05' OR obs_date >= DATE '2001-10-30'
       THEN CAST(-999 AS DOUBLE) ELSE air_temp END                   AS air_temp,
  CASE WHEN k % 23 = 7 THEN CAST(-999 AS DOUBLE) ELSE precip END     AS precip,
  CASE WHEN k % 19 = 2 AND station = 'N' THEN CAST(-999 AS DOUBLE) ELSE vapor_pressure END AS vapor_pressure,
  precip_kind, snow_depth
FROM base)"""

# every 29 days of the calendar the later dates move one day further
_GAPPED_DATE = ("CAST(l_shipdate AS DATE) + CAST(FLOOR(((YEAR(CAST(l_shipdate AS DATE)) - 1992) * 366 "
                "+ DAYOFYEAR(CAST(l_shipdate AS DATE))) / 29.0) AS INT)")


def obs_ctes(many: bool = False) -> str:
    """CTE list (without the leading WITH) that defines ``obs``."""
    station = "CAST(l_suppkey AS STRING)" if many else "l_returnflag"
    return _base_cte(station, "CAST(l_shipdate AS DATE)" if many else _GAPPED_DATE) + ",\n" + _OBS_SELECT


def with_obs(sql_body: str, many: bool = False) -> str:
    """Wrap a query over ``obs`` (and optional extra CTEs) for the oracle."""
    body = sql_body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + obs_ctes(many) + ",\n" + body[5:]
    return "WITH " + obs_ctes(many) + "\n" + body


def _sql_over(spark: SparkSession, text: str, sf_dir: str, table: str) -> DataFrame:
    """Run the shared SQL text in Spark with the table passed as a DataFrame
    argument (no session-wide view name that another query could replace)."""
    return spark.sql(text.replace(f"FROM {table}", f"FROM {{{table}}}"),
                     **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


# derived tables already written in this application:
# (app id, dir, kind) -> (version of the input, path)
_STORED: dict[tuple[str, str, str], tuple[str, str]] = {}
_INPUTS = ("lineitem", "events")


def _version(spark: SparkSession, sf_dir: str) -> str:
    """Sizes and modification times of the input files, so that a derived
    table is made anew when its input has changed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for table in _INPUTS:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            seen += [f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(p)]
    return "|".join(sorted(seen))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    """Derive a stand-in table once per application and keep it as Parquet in
    the shared folder, as a deployment keeps its long station table; later
    queries read it (with filters and projections pushed into the scan)."""
    from ..session import scratch_path, shuffles_dropped

    key = (spark.sparkContext.applicationId, sf_dir.rstrip('/'), kind)
    version = _version(spark, sf_dir)
    known = _STORED.get(key)
    if known is None or known[0] != version or not _exists(spark, known[1]):
        path = scratch_path(spark, f"standin-{kind}")
        table = build()
        with shuffles_dropped(spark) if kind == "stations-many" else nullcontext():  # the largest of them
            table.write.mode("overwrite").parquet(path)
        known = _STORED[key] = (version, path)
    return spark.read.parquet(known[1])


def station_obs(spark: SparkSession, sf_dir: str, many: bool = False) -> DataFrame:
    """Long table ``(series_id STRING, obs_date DATE, 5 x DOUBLE)`` with sentinels."""
    return stored(spark, sf_dir, "stations-many" if many else "stations",
                   lambda: _sql_over(spark, "WITH " + obs_ctes(many) + "\nSELECT * FROM obs",
                                     sf_dir, "lineitem"))


# Event-level series with one hot key: every third user's events form the
# series 'hot' (a third of all rows); every other user is its own short
# series.  Sub-daily timestamps as the order key, event_id breaks ties,
# every seventh value is missing.
EVENT_SERIES_CTE = """ev AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS STRING) END AS series_id,
         ts, event_id,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value
  FROM events)"""


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "events",
                   lambda: _sql_over(spark, "WITH " + EVENT_SERIES_CTE + "\nSELECT * FROM ev", sf_dir, "events"))
