"""Configuration: thresholds, lag maps, feature lists, model settings.

Everything under "Fixed values" must stay equal to the behaviour we
reproduce; everything else is our own choice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must match the reproduced behaviour)
# ---------------------------------------------------------------------------

# sensor quality thresholds
MAX_GAP = 30
MAX_Q = 10.0
MIN_COVERAGE_PCT = 70
MIN_BAD_MONTH_PCT = 0.20

# series repair and target
HORIZON = 1
LIMIT = 1
DEFAULT_APPROACH = "custom"

# lag maps {output column: (input column, row shift)}; lag_1 is today (shift 0)
CUSTOM_SHIFTS = {
    "lag_1": ("pm25_avg", 0),
    "lag_2": ("pm25_avg", 1),
    "lag_3": ("pm25_avg", 2),
    "lag_7": ("pm25_avg", 6),
}
ALL_LAGS_14_SHIFTS = {f"lag_{k + 1}": ("pm25_avg", k) for k in range(14)}
ALL_LAGS_21_SHIFTS = {f"lag_{k + 1}": ("pm25_avg", k) for k in range(21)}

# shifts averaged into lag_avg_14 (null-propagating mean)
LAG_AVG_SHIFTS = (12, 13, 14)
# rolling window of week_std (rows, full window required, ddof=1)
WEEK_STD_WINDOW = 7

# selected model features, in this order
SELECTED_FEATURES = [
    "lag_1",
    "lag_3",
    "lag_7",
    "city",
    "wind_speed",
    "precipitation",
    "lag_avg_14",
    "week_std",
    "wind_direction",
    "pressure",
    "temp_max",
    "humidity",
    "temp_min",
    "month_cos",
    "temp_gradient",
]

# merged table column order
MERGED_COLUMNS = [
    "city",
    "date",
    "pm25_avg",
    "temp_min",
    "temp_max",
    "cloud_cover",
    "humidity",
    "precipitation",
    "pressure",
    "wind_speed",
    "wind_direction",
]

# monitoring margins, in percent
DRIFT_THRESHOLD = 10
IMPROVEMENT_THRESHOLD = 1

# batch windows are 42 days; evaluation needs a 14-day warm-up before a batch
BATCH_DAYS = 42
BATCH_COUNT = 6
WARMUP_DAYS = 14

# payload admission: share of days that must be present
MIN_PAYLOAD_COMPLETENESS = 0.75
# station search radius in metres; PM2.5 parameter id in the station payload
STATION_RADIUS_M = 7000
PM25_PARAMETER_ID = 2

# city coordinates (latitude, longitude), in this order
CITIES = [
    ("Paris", 48.8622, 2.3470),
    ("Lyon", 45.7267, 4.8275),
    ("New York", 40.8259, -73.9508),
    ("London", 51.5045, -0.1363),
    ("Berlin", 52.4990, 13.4437),
    ("Rome", 41.9028, 12.4964),
]

# model aliases
CHAMPION = "champion"
CHALLENGER = "challenger"
ARCHIVED = "archived"

# time folds: 5 expanding folds, 30-day test blocks, 7-day gap
FOLD_COUNT = 5
FOLD_TEST_DAYS = 30
FOLD_GAP_DAYS = 7

# autocorrelation: number of lags and two-sided 95% normal quantile
ACF_LAGS = 60
Z_975 = 1.959963984540054

RANDOM_SEED = 273

# ---------------------------------------------------------------------------
# Our own choices
# ---------------------------------------------------------------------------

# MLlib boosted trees (the in-process library's leaf/regularisation knobs do
# not exist in MLlib; these are sized for Spark, not copied).
GBT_PARAMS = dict(maxIter=50, maxDepth=5, stepSize=0.1, subsamplingRate=0.91, seed=RANDOM_SEED)
# ranges of the parameter search (low, high, drawn on a log scale), and how many points are drawn;
# the rounds are not drawn, they are what the search spends (forecast.param_search)
SEARCH_RANGES = dict(maxDepth=(3, 8, False), stepSize=(0.01, 0.3, True),
                     subsamplingRate=(0.5, 1.0, False), minInstancesPerNode=(10, 100, False))
SEARCH_TRIALS = 18
# boosting rounds of the search's last rung; a rung before it has a third of them
SEARCH_ROUNDS = 30


# Rounding applied to doubles in registered queries so that Spark and the SQL
# oracle hash to the same values although they sum in different orders:
# nearest multiple of 2^-ROUND_BITS (about 7 significant decimals after the point).
ROUND_BITS = 24


@dataclass(frozen=True)
class PreprocessConfig:
    max_gap: int = MAX_GAP
    max_q: float = MAX_Q
    min_coverage_pct: float = MIN_COVERAGE_PCT
    min_bad_month_pct: float = MIN_BAD_MONTH_PCT
    approach: str = DEFAULT_APPROACH
    limit: int = LIMIT
    horizon: int = HORIZON
    features: tuple = field(default_factory=lambda: tuple(SELECTED_FEATURES))


def shifts_for(approach: str) -> dict:
    """Lag map of a feature approach; unknown approach is an error."""
    if approach == "custom":
        return CUSTOM_SHIFTS
    if approach == "all_lags_14":
        return ALL_LAGS_14_SHIFTS
    if approach == "all_lags_21":
        return ALL_LAGS_21_SHIFTS
    raise ValueError(
        "approach must be 'custom', 'all_lags_14' or 'all_lags_21', "
        f"got {approach!r}"
    )


def features_for(approach: str) -> list[str]:
    """Feature list per approach.

    The custom approach uses the selected list.  The all-lags approaches
    never build lag_avg_14 / week_std, so their list is the selected list
    with those replaced by the full set of lags.
    """
    if approach == "custom":
        return list(SELECTED_FEATURES)
    lags = list(shifts_for(approach))
    rest = [f for f in SELECTED_FEATURES if not f.startswith("lag_") and f != "week_std"]
    return lags + rest
