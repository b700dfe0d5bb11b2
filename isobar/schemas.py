"""Wire and storage schemas.

Fixed values: field names and types must equal those of the messages and
documents exchanged with existing producers and consumers.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

TEXT, NUMBER, COUNT, WHOLE, FLAG = StringType(), DoubleType(), LongType(), IntegerType(), BooleanType()


def record(**fields: DataType) -> StructType:
    """A struct of nullable fields, in the order given."""
    built = StructType()
    for name, kind in fields.items():
        built = built.add(name, kind)
    return built


def same(kind: DataType, names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), kind)


MESSAGE = record(
    key=TEXT, value=TEXT, timestamp=TimestampType(), topic=TEXT, partition=WHOLE, offset=COUNT
)

_LOCATION = same(NUMBER, "latitude longitude") | same(TEXT, "city country location_name")
LOCATION = record(**_LOCATION)

CURRENT_WEATHER = record(
    **same(NUMBER, "temperature windspeed winddirection"), weathercode=WHOLE, time=TEXT
)

CURRENT_RESPONSE = record(**_LOCATION, current_weather=CURRENT_WEATHER)

RAW_READING = record(timestamp=TEXT, location=LOCATION, current_weather=CURRENT_WEATHER, source=TEXT)

FLAT_READING = record(
    event_time=TEXT,
    **_LOCATION,
    **same(NUMBER, "temperature windspeed winddirection"),
    weathercode=WHOLE,
    **same(TEXT, "weather_time wind_alert_level heat_alert_level original_timestamp data_source"),
)

HISTORY_DOCUMENT = record(
    metadata=record(
        location=LOCATION,
        period=record(start_date=TEXT, end_date=TEXT, years=WHOLE),
        downloaded_at=TEXT,
        source=TEXT,
    ),
    data=record(
        daily=record(
            time=ArrayType(TEXT),
            **same(
                ArrayType(NUMBER),
                "temperature_2m_max temperature_2m_min temperature_2m_mean precipitation_sum "
                "windspeed_10m_max windspeed_10m_mean winddirection_10m_dominant",
            ),
        )
    ),
)

DAILY = record(
    date=TEXT,
    year=WHOLE,
    **same(TEXT, "city country"),
    **same(
        NUMBER,
        "latitude longitude temperature_max temperature_min temperature_mean precipitation windspeed_max windspeed_mean",
    ),
)

MONTH_AVERAGES = same(
    NUMBER,
    "avg_temperature avg_temperature_max avg_temperature_min avg_windspeed avg_windspeed_max "
    "avg_precipitation total_precipitation alert_probability",
)
MONTH_DISPERSION = same(
    NUMBER,
    "std_temperature min_temperature max_temperature min_temperature_min max_temperature_max "
    "std_windspeed min_windspeed max_windspeed min_windspeed_max max_windspeed_max",
)
MONTH_QUARTILES = same(NUMBER, "temp_q25 temp_median temp_q75 wind_q25 wind_median wind_q75")
MONTH_DAYS = same(
    COUNT,
    "days_with_alert total_days wind_level_1_days wind_level_2_days heat_level_1_days heat_level_2_days",
)

SEASONAL_MONTH = record(month=WHOLE, month_name=TEXT, **MONTH_AVERAGES, **MONTH_DAYS)
ENRICHED_MONTH = record(
    month=WHOLE, month_name=TEXT, **MONTH_AVERAGES, **MONTH_DISPERSION, **MONTH_QUARTILES, **MONTH_DAYS
)

VALIDATION = record(
    country=TEXT,
    city=TEXT,
    year=WHOLE,
    months_count=WHOLE,
    missing_months=ArrayType(WHOLE),
    is_complete=FLAG,
)

SEASONAL_DOCUMENT = record(
    **same(TEXT, "city country"),
    **same(NUMBER, "latitude longitude"),
    monthly_profiles=ArrayType(SEASONAL_MONTH),
    **same(TEXT, "computed_at source"),
)

ENRICHED_DOCUMENT = record(
    **same(TEXT, "city country"),
    **same(NUMBER, "latitude longitude"),
    year=WHOLE,
    monthly_profiles=ArrayType(ENRICHED_MONTH),
    validation=VALIDATION,
    **same(TEXT, "computed_at source validation_status"),
)

RECORD_DOCUMENT = record(
    **same(TEXT, "city country"),
    **same(NUMBER, "latitude longitude"),
    records=record(
        hottest_day=record(date=TEXT, temperature=NUMBER),
        coldest_day=record(date=TEXT, temperature=NUMBER),
        strongest_wind=record(date=TEXT, windspeed=NUMBER),
        rainiest_day=record(date=TEXT, precipitation=NUMBER),
    ),
    statistics=record(total_days=COUNT),
    computed_at=TEXT,
)

ANOMALY_MESSAGE = record(
    **same(TEXT, "event_time city country variable"),
    **same(NUMBER, "observed_value expected_value"),
    anomaly_type=TEXT,
)

ANOMALY_ROW = record(
    **same(TEXT, "event_time anomaly_type"),
    **same(
        NUMBER,
        "observed_temperature expected_temperature observed_windspeed expected_windspeed "
        "temp_deviation wind_deviation",
    ),
)
ANOMALY_PLACE = record(country=TEXT, city=TEXT, year=WHOLE, month=WHOLE)
ANOMALY_FILE = record(**same(TEXT, "country city"), **same(WHOLE, "year month"), anomalies=ArrayType(ANOMALY_ROW))

ALERT_ENTRY = record(timestamp=TEXT, alert_data=FLAT_READING)
