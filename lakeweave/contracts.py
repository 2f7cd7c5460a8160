"""One ``StructType`` per layer table, used for reading, conforming and verifying.

Fixed values: names, types and order are the published schemas of the tables.
"""

from __future__ import annotations

from pyspark.sql import types as T


ATOMS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def atom(name: str) -> T.DataType:
    if name.startswith("decimal("):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return ATOMS[name]


def schema(lines: str, required: tuple[str, ...] = ()) -> T.StructType:
    """One ``name type`` per line; names in ``required`` become non-nullable."""
    pairs = [line.split() for line in lines.strip().splitlines()]
    return T.StructType([T.StructField(name, atom(kind), name not in required) for name, kind in pairs])


def record(**fields: str | T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, atom(kind) if isinstance(kind, str) else kind)
                         for name, kind in fields.items()])


# Bronze -------------------------------------------------------------------

BRONZE_TAXI = schema("""
    vendorid int
    tpep_pickup_datetime timestamp
    tpep_dropoff_datetime timestamp
    passenger_count double
    trip_distance double
    ratecodeid double
    store_and_fwd_flag string
    pulocationid int
    dolocationid int
    payment_type bigint
    fare_amount double
    extra double
    mta_tax double
    tip_amount double
    tolls_amount double
    improvement_surcharge double
    total_amount double
    congestion_surcharge double
    airport_fee double
""")

ZONE_LOOKUP = schema("""
    LocationID int
    Borough string
    Zone string
    service_zone string
""")

BRONZE_AIR = schema("""
    location_id bigint
    location_name string
    locality string
    timezone string
    latitude double
    longitude double
    sensor_id bigint
    parameter_id bigint
    parameter_name string
    parameter_units string
    parameter_display string
    date string
    value double
""")

BRONZE_WEATHER = schema("""
    date timestamp
    ZoneName string
    temperature_2m float
    relative_humidity_2m float
    precipitation float
    wind_speed_10m float
    rain float
    snowfall float
    wind_direction_10m float
""")

# The 32 columns of the exchange-rate file, in file order.
FX_FILE = schema("""
    KEY string
    FREQ string
    CURRENCY string
    CURRENCY_DENOM string
    EXR_TYPE string
    EXR_SUFFIX string
    TIME_PERIOD date
    OBS_VALUE double
    OBS_STATUS string
    OBS_CONF string
    OBS_PRE_BREAK string
    OBS_COM string
    TIME_FORMAT string
    BREAKS string
    COLLECTION string
    COMPILING_ORG string
    DISS_ORG string
    DOM_SER_IDS string
    PUBL_ECB string
    PUBL_MU string
    PUBL_PUBLIC string
    UNIT_INDEX_BASE string
    COMPILATION string
    COVERAGE string
    DECIMALS bigint
    NAT_TITLE string
    SOURCE_AGENCY string
    SOURCE_PUB string
    TITLE string
    TITLE_COMPL string
    UNIT string
    UNIT_MULT bigint
""")

FX_DROPPED = (
    "KEY", "OBS_CONF", "OBS_PRE_BREAK", "OBS_COM", "TIME_FORMAT", "BREAKS",
    "COMPILING_ORG", "DISS_ORG", "DOM_SER_IDS", "PUBL_ECB", "PUBL_MU",
    "PUBL_PUBLIC", "COMPILATION", "COVERAGE", "NAT_TITLE", "SOURCE_PUB",
)

BRONZE_FX = T.StructType([f for f in FX_FILE if f.name not in FX_DROPPED])

GDP_RECORD = record(
    indicator=record(id="string", value="string"),
    country=record(id="string", value="string"),
    countryiso3code="string", date="string", value="string", unit="string",
    obs_status="string", decimal="string",
)

BRONZE_GDP = schema("""
    indicator_id string
    indicator_value string
    country_id string
    country_value string
    countryiso3code string
    date bigint
    value bigint
    decimal double
""")

LOCATION_PAGE = record(results=T.ArrayType(record(
    id="bigint", name="string", locality="string", timezone="string",
    coordinates=record(latitude="double", longitude="double"),
    sensors=T.ArrayType(record(
        id="bigint",
        parameter=record(id="bigint", name="string", units="string", displayName="string"),
    )),
)))

READING_PAGE = record(results=T.ArrayType(record(
    value="double",
    period=record(datetimeFrom=record(utc="string")),
)))

# Silver -------------------------------------------------------------------

SILVER_TAXI = schema("""
    pickup_datetime timestamp
    dropoff_datetime timestamp
    passenger_count int
    trip_distance double
    total_amount decimal(10,2)
    congestion_surcharge decimal(10,2)
    pickup_year int
    pickup_hour int
    pickup_day int
    pickup_month int
    pickup_borough string
    pickup_zone string
""")

SILVER_AIR = schema("""
    date date
    location_name string
    locality string
    timezone string
    parameter_name string
    value double
    parameter_units string
    latitude double
    longitude double
    year int
    month int
    dayofweek int
""")

SILVER_FX = schema("""
    date date
    base_currency string
    target_currency string
    exchange_rate decimal(10,4)
""")

SILVER_GDP = schema("""
    year int
    country_code string
    gdp_usd bigint
""")

SILVER_WEATHER = schema("""
    DateKey int
    weather_timestamp timestamp
    zone_name string
    hour_of_day int
    year int
    month int
    day_of_week int
    temperature_c double
    humidity_% double
    precipitation_mm double
    rain_mm double
    snowfall_cm double
    wind_speed_kmh double
    wind_direction_deg int
""")

# Gold and serving -----------------------------------------------------------

DIM_DATE = schema("""
    DateKey date
    YearKey int
    MonthNumber int
    MonthName string
    Quarter int
    DayName string
    IsWeekend int
""", required=("IsWeekend",))

DIM_FX = schema("""
    DateKey date
    ExchangeRate decimal(18,4)
""")

DIM_GDP = schema("""
    YearKey int
    GDP_Value decimal(18,2)
""")

DIM_ZONE = schema("""
    StandardZone string
    SourceType string
""", required=("SourceType",))

FACT_TAXI_DAILY = schema("""
    DateKey date
    HourOfDay int
    pickup_zone string
    TotalTrips int
    TotalRevenue decimal(18,2)
    AvgFare decimal(10,2)
    AvgTripDistance decimal(10,2)
    AvgTripDuration decimal(10,2)
""")

FACT_AIR_DAILY = schema("""
    DateKey date
    timezone string
    locality string
    location_name string
    Pollutant string
    AvgValue decimal(10,2)
    ReadingCount int
""")

WEATHER_METRICS = schema("""
    time timestamp
    zone string
    temp double
    humidity double
    precipitation double
    rain double
    snow double
    wind_speed double
    wind_direction int
""", required=("time",))
