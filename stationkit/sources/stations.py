"""Station files (S1, S2, S6) and model tables.

Station files are CSV with a header whose names are padded with blanks on
the left, a ``dd.MM.yyyy`` date, and -999 for missing values.  Files that share
a header are read in one scan; the station name comes from the file path.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATE_TEXT_FORMAT
from ..operators.clean import parse_date


def write_station_files(obs: DataFrame, path: str, series_col: str = "series_id",
                        date_col: str = "obs_date", pad: int = 2) -> None:
    """Write a long table as one CSV folder per station, in station-file
    form (padded header, text date, sentinel kept)."""
    cols = [c for c in obs.columns if c not in (series_col, date_col)]
    out = obs.select(F.col(series_col),
                     F.date_format(F.col(date_col), DATE_TEXT_FORMAT).alias(" " * pad + "DATE"),
                     *[F.col(c).alias(" " * pad + c) for c in cols])
    out.write.mode("overwrite").partitionBy(series_col).option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).csv(path)


def _files_by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Station files grouped by their (stripped) header, one name per station
    file to the driver."""
    heads = (spark.read.option("recursiveFileLookup", True).text(paths)
             .where(F.col("value").rlike(r'(^|,)\s*"?DATE"?\s*(,|$)'))
             .select(F.col("_metadata.file_path").alias("file"), "value").distinct().collect())
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(heads):
        names = tuple(c.strip().strip('"').strip() for c in r["value"].split(","))
        out.setdefault(names, []).append(unquote(r["file"]))
    return out


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            found.append(p)
    return found


def read_station_files(spark: SparkSession, path: str, series_col: str = "series_id",
                       date_col: str = "obs_date", series: list[str] | None = None,
                       name_pattern: str = r"([^/]+?)\.csv$") -> DataFrame:
    """S1 + S2 + S6: read the station files (all of them, or only those of
    ``series``, so unrequested stations are not read): folders
    ``{series_col}=NAME/`` or flat files, whose station is the group of
    ``name_pattern`` in the path (for a flat file of a station in ``series``:
    ``NAME.csv``).

    Each file is read by its own header, so files may order, add or leave out
    columns; a measure that a file lacks is null there.  No schema inference
    pass: values come in as text, names are stripped (S6), the date is parsed
    (S2/P7) and measures are cast with ``try_cast`` so dirty cells become null
    instead of failing the job."""
    root = path.rstrip("/")
    paths = [path]
    if series:
        paths = _existing(spark, [x for s in series for x in (f"{root}/{series_col}={s}", f"{root}/{s}.csv")])
        if not paths:
            raise FileNotFoundError(f"no files of {series} in {path}")
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(file, f"{series_col}=([^/]+)/", 1)
    station = F.when(folder != "", folder).otherwise(F.regexp_extract(file, name_pattern, 1))
    groups = _files_by_header(spark, paths)
    measures = list(dict.fromkeys(c for names in groups for c in names if c != "DATE"))
    parts = []
    for names, files in groups.items():
        schema = ", ".join(f"`{c}` string" for c in names)
        raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
               .option("ignoreLeadingWhiteSpace", True).csv(files))
        parts.append(raw.select(station.alias(series_col), parse_date(F.col("DATE"), DATE_TEXT_FORMAT).alias(date_col),
                                *[F.col(f"`{c}`").try_cast("double").alias(c) if c in names
                                  else F.lit(None).cast("double").alias(c) for c in measures]))
    if not parts:
        raise ValueError(f"no station file with a DATE column in {paths}")
    return reduce(DataFrame.unionByName, parts)


def write_model_tables(sup: DataFrame, path: str, features: list[str], goals: list[str],
                       date_col: str, row_id: str = "row_id") -> dict[str, str]:
    """Features, goals and timings as three Parquet tables that share
    an explicit ``row_id`` (alignment never relies on file order)."""
    paths = {}
    for name, cols in (("features", features), ("goals", goals), ("timings", [date_col])):
        p = f"{path}/{name}"
        sup.select(row_id, *cols).write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def read_model_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """S3: the three tables back."""
    return {k: spark.read.parquet(v) for k, v in paths.items()}


def write_bucketed_long_table(df: DataFrame, name: str, path: str, buckets: int,
                              series_col: str = "series_id", date_col: str = "obs_date") -> DataFrame:
    """Store a long table bucketed and sorted by series, as an external table
    at ``path`` (the shared folder).  Per-series windows on it then need no
    shuffle: the scan already delivers each series in one bucket."""
    (df.write.mode("overwrite").bucketBy(buckets, series_col).sortBy(series_col, date_col)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
