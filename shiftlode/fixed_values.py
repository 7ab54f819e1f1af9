"""Limits, defaults, names and message texts that results must carry.

Nothing here is computed. They are kept in one place so that every operator takes
its limits from a single list and callers can pass their own instead.
"""

# --- Fixed values: cleaning, filling and weather scoring -------------------------
GRADE_MIN, GRADE_MAX = 0.0, 10.0
DEFAULT_UTILIZATION = 50.0
DEFAULT_FUEL = 5.0
DEFAULT_TEMPERATURE = 26.0
DEFAULT_RAIN = 0.0
SITE_LATITUDE = 2.0167
SITE_LONGITUDE = 117.3
SITE_TIMEZONE = "Asia/Jakarta"
ACTIVE_STATUS = "active"
IMPACT_FULL_SCORE = 100.0
HIGH_RAIN_MM = 5.0
RAIN_POINTS_PER_MM = 2.0
COMFORT_TEMPERATURE = 25.0
TEMPERATURE_POINTS_PER_DEGREE = 1.5

# --- Fixed values: quality rules per table ---------------------------------------
RULES = {
    "production_logs": {
        "ranges": {"tons_extracted": (0, 1000), "quality_grade": (0, 10)},
        "allowed": {},
        "required": ["date", "mine_id", "shift", "tons_extracted", "quality_grade"],
        "keys": ["date", "mine_id", "shift"],
        "date_column": "date",
    },
    "equipment_sensors": {
        "ranges": {"fuel_consumption": (0, 50)},
        "allowed": {"status": ["active", "idle", "maintenance"]},
        "required": ["timestamp", "equipment_id", "status", "fuel_consumption", "maintenance_alert"],
        "keys": ["timestamp", "equipment_id"],
        "date_column": "timestamp",
    },
    "weather_data": {
        "ranges": {"temperature_mean": (-10, 50), "precipitation_sum": (0, 500)},
        "allowed": {},
        "required": ["date", "latitude", "longitude", "temperature_mean", "precipitation_sum"],
        "keys": ["date"],
        "date_column": "date",
    },
    "daily_production_metrics": {
        "ranges": {
            "total_production_daily": (0, 10000),
            "average_quality_grade": (0, 10),
            "equipment_utilization": (0, 100),
            "fuel_efficiency": (0, 20),
            "weather_impact_score": (0, 100),
        },
        "allowed": {},
        "required": [
            "date", "total_production_daily", "average_quality_grade",
            "equipment_utilization", "fuel_efficiency", "weather_impact_score",
        ],
        "keys": ["date"],
        "date_column": "date",
    },
}

# --- Fixed values: declared constraints per table ----------------------------------
NOT_NULL = {
    "mines": ["mine_code", "mine_name", "location", "operational_status"],
    "production_logs": ["date", "mine_id", "shift"],
    "equipment_sensors": ["timestamp", "equipment_id", "status"],
    "weather_data": ["date"],
    "daily_production_metrics": ["date"],
}

UNIQUE = {"mines": ["mine_id"], "weather_data": ["date"], "daily_production_metrics": ["date"]}
ID_COLUMNS = {
    "production_logs": "log_id",
    "equipment_sensors": "id",
    "weather_data": "id",
    "daily_production_metrics": "id",
}

# --- Fixed values: rows of the quality log ------------------------------------------
ISSUE_BEFORE = "Found "
ISSUE_AFTER = " records with negative tons_extracted, replaced with 0"
ISSUE_SEVERITY = "WARNING"

# --- Fixed values: quality score (points per percent, largest deduction) -----------
NULL_POINTS, NULL_CAP = 0.5, 20.0
RANGE_POINTS, RANGE_CAP = 0.8, 30.0
DUPLICATE_POINTS, DUPLICATE_CAP = 0.3, 15.0
ANOMALY_POINTS, ANOMALY_CAP = 5.0, 25.0
HEALTH_BUCKETS = [(95, "excellent"), (85, "good"), (70, "fair")]
HEALTH_OTHERWISE = "poor"
CRITICAL_SCORE = 70.0

# --- Fixed values: message texts ---------------------------------------------------
ADVICE_NULLS = "Implement data completeness checks to reduce null values"
ADVICE_RANGES = "Add data range validation at ingestion to prevent out-of-range values"
ADVICE_DUPLICATES = "Implement deduplication logic to prevent duplicate records"
ADVICE_SCORE_90 = "Overall data quality needs improvement - review data collection processes"
ADVICE_SCORE_70 = "Critical data quality issues detected - immediate attention required"
ADVICE_REPORT_SCORE = "Implement automated data quality monitoring"
ADVICE_REPORT_ANOMALIES = "Investigate root causes of production anomalies"
ADVICE_REPORT_WEATHER = "Ensure weather data collection is reliable and complete"
REPORT_SCORE_LIMIT = 85.0
REPORT_ANOMALY_LIMIT = 5
REPORT_SINCE = "2024-07-01"
REPORT_WEATHER_UNTIL = "2024-12-31"
ALERT_PRODUCTION = ("Production significantly below average: ", " tons")
ALERT_UTILIZATION = ("Low equipment utilization: ", "%")
ALERT_GRADE = ("Poor coal quality detected: ", "")
ALERT_TREND = "Declining production trend detected over the analysis period"
ALERT_STD_FACTOR = 2.0
ALERT_UTILIZATION_LIMIT = 50.0
ALERT_GRADE_LIMIT = 3.0
FLAG_NEGATIVE_TONS = "negative_tons_extracted"
FLAG_INVALID_GRADE = "invalid_quality_grade"
FLAG_NEGATIVE_TOTAL = "negative_total_production"
FLAG_INVALID_UTILIZATION = "invalid_equipment_utilization"
FLAG_MISSING_WEATHER = "missing_weather_data"

# --- Fixed values: outliers and trend ----------------------------------------------
METRICS = [
    "total_production_daily", "average_quality_grade", "equipment_utilization",
    "fuel_efficiency", "weather_impact_score",
]
IQR_FACTOR = 1.5
HIGH_SEVERITY_STD = 3.0
MIN_ROWS_FOR_STATS = 7
MIN_ROWS_FOR_TREND = 5
TREND_THRESHOLD = 0.1
RECENT_DAYS = 30

# --- Fixed values: forecasting -----------------------------------------------------
TARGET = "total_production_daily"
BASE_FEATURES = [
    "average_quality_grade", "equipment_utilization", "fuel_efficiency", "weather_impact_score",
]
LAGS = [1, 2, 3, 7]
ROLLING_WINDOWS = [3, 7, 14]
TEST_SHARE = 0.2
FOLDS = 5
SEED = 42
RANDOM_DRAWS = 20
TARGET_BINS = 30
FEATURE_BINS = 20
# The forest of Spark ML has no smallest node size for a split, so that list is left out.
MODEL_GRIDS = {
    "Linear_Regression": {},
    "Ridge_Regression": {"alpha": [0.1, 1.0, 10.0, 100.0]},
    "Random_Forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [10, 20, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    "Gradient_Boosting": {
        "n_estimators": [100, 200],
        "learning_rate": [0.05, 0.1, 0.15],
        "max_depth": [3, 5, 7],
        "subsample": [0.8, 0.9, 1.0],
    },
}
FLOAT_EPSILON = 2.220446049250313e-16

# --- Fixed values: feature columns in order ------------------------------------------
FEATURE_NAMES = [
    "average_quality_grade", "equipment_utilization", "fuel_efficiency", "weather_impact_score",
    "temperature_mean", "precipitation_sum",
    "total_production_daily_lag_1", "total_production_daily_lag_2",
    "total_production_daily_lag_3", "total_production_daily_lag_7",
    "total_production_daily_rolling_mean_3", "total_production_daily_rolling_std_3",
    "total_production_daily_rolling_mean_7", "total_production_daily_rolling_std_7",
    "total_production_daily_rolling_mean_14", "total_production_daily_rolling_std_14",
    "year", "month", "day", "day_of_year", "week_of_year", "day_of_week", "is_weekend",
    "quality_utilization", "efficiency_weather",
    "equipment_utilization_squared", "equipment_utilization_log",
    "average_quality_grade_squared", "average_quality_grade_log",
    "temp_deviation", "high_precipitation", "time_index",
]
SAME_DAY_FEATURES = ["fuel_efficiency", "efficiency_weather"]

# --- Fixed values: column order of the stored daily table --------------------------
DAILY_COLUMNS = [
    "date", "total_production_daily", "average_quality_grade", "equipment_utilization",
    "fuel_efficiency", "weather_impact_score", "temperature_mean", "precipitation_sum",
    "anomaly_flags",
]
