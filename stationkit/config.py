"""Configuration and column-name templates.

One frozen object carries everything the preparation job needs: which measures
are features, which are forecast targets, how far ahead to forecast, how many
past days to add, which value marks "missing", and which series is the target.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference's settings for equal results.
#   missing-value sentinel in the station files: -999
#   forecast horizon: 3 days ahead; past days used as features: 0
#   date text format of the station files: day.month.year (dd.MM.yyyy)
#   goal column template: {series}_{target}_future_{k}Day
#   past feature template: {measure}_past_{k}Day
#   cut-off date of the older linear study: 1996-05-01
#   split-size sweep: 10 iterations, horizons 1 2 3, test sizes 0.1 0.2 0.3 0.4 0.5
#   chronological split: first 80 % of rows train
#   histogram: 100 equal-width bins
#   stride of the date-axis sample: every 128th row
#   penalty factor for negative predictions: 10
#   weighted fill: +-5 neighbour rows, weight exp(-0.1 * distance)
#   dense network layout: 64 relu, 32 elu, 3 linear
#   plot boxes (actual, predicted): temperature -10..25 and -10..25,
#   precipitation 0..30 and -1..6
# ---------------------------------------------------------------------------
SENTINEL = -999.0
HORIZONS = 3
PAST_DAYS = 0
DATE_TEXT_FORMAT = "dd.MM.yyyy"
GOAL_TEMPLATE = "{series}_{target}_future_{k}Day"
PAST_TEMPLATE = "{measure}_past_{k}Day"
CUTOFF_DATE = "1996-05-01"
SWEEP_ITERATIONS = 10
SWEEP_TEST_SIZES = (0.1, 0.2, 0.3, 0.4, 0.5)
TRAIN_FRACTION = 0.8
HIST_BINS = 100
STRIDE = 128
NEGATIVE_PENALTY = 10.0
FILL_RADIUS = 5
FILL_DECAY = 0.1
PLOT_BOXES = {"air_temp": ((-10.0, 25.0), (-10.0, 25.0)), "precip": ((0.0, 30.0), (-1.0, 6.0))}
# columns that the older study drops by name
OLDER_DROPPED = ("snow_depth_arb", "snow_depth_sch", "precip_kind_arb")
DENSE_LAYERS = ((64, "relu"), (32, "elu"), (3, "linear"))


@dataclass(frozen=True)
class Config:
    """Settings of the supervised-table job.

    ``series`` lists the stations in feature order; ``target_series`` is the
    station whose future values are forecast.  Measures are the long-table
    columns; in the driver-table stand-in they are named after what they model.
    """

    series_col: str = "series_id"
    date_col: str = "obs_date"
    features: tuple[str, ...] = (
        "air_temp", "precip", "vapor_pressure", "precip_kind", "snow_depth")
    targets: tuple[str, ...] = ("air_temp", "precip")
    interpolate: tuple[str, ...] = ("air_temp",)
    horizons: int = HORIZONS
    past_days: int = PAST_DAYS
    sentinel: float = SENTINEL
    series: tuple[str, ...] = ("A", "N", "R")
    target_series: str = "R"
    # rows of one series that one window task may hold before the
    # skew-safe chunked path is used (see operators/series_window.py)
    max_rows_per_task: int = 2_000_000
    chunk_days: int = 366

    @property
    def measures(self) -> tuple[str, ...]:
        seen: list[str] = []
        for c in self.features + self.targets:
            if c not in seen:
                seen.append(c)
        return tuple(seen)

    def goal_name(self, target: str, k: int, series: str | None = None) -> str:
        return GOAL_TEMPLATE.format(series=series or self.target_series, target=target, k=k)

    def future_name(self, target: str, k: int) -> str:
        # name of the shifted column inside the long table, before prefixing
        return f"{target}_future_{k}Day"

    def past_name(self, measure: str, k: int) -> str:
        return PAST_TEMPLATE.format(measure=measure, k=k)

    def feature_columns(self) -> list[str]:
        """Series x feature x past-lag, in the reference's nesting order."""
        cols = []
        for s in self.series:
            for f in self.features:
                cols.append(f"{s}_{f}")
                for k in range(1, self.past_days + 1):
                    cols.append(f"{s}_{self.past_name(f, k)}")
        return cols

    def goal_columns(self) -> list[str]:
        """Target series x target x horizon."""
        return [self.goal_name(t, k) for t in self.targets for k in range(1, self.horizons + 1)]


DEFAULT = Config()
