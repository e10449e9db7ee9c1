"""Declared schemas of the record and of the three layers.

Every scan passes one of these: partition columns are otherwise typed from
their directory names, which turns '007' into 7 and an all-null key into void.
"""

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "binary": BinaryType(),
}


def table(columns: str, required: tuple[str, ...] = ()) -> StructType:
    """``"name type, ..."`` -> schema. Unlike DDL parsing it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(n, _TYPES[t], n not in required) for n, t in pairs])


# Names, types and order are the contract of the data model.
RECORD = table(
    "id string, name string, brewery_type string, "
    "address_1 string, address_2 string, address_3 string, "
    "city string, state_province string, postal_code string, country string, "
    "longitude double, latitude double, "
    "phone string, website_url string, state string, street string"
)
BRONZE = table(
    "ingestion_timestamp timestamp, ingestion_date date, source_system string, payload string",
    required=("ingestion_timestamp", "ingestion_date"),
)
SILVER_FIELDS = (
    "id name brewery_type address_1 address_2 address_3 street city state "
    "state_province country postal_code longitude latitude phone website_url"
).split()
GOLD_KEYS = ["brewery_type", "country", "state_province", "city"]
GOLD_COUNT = "num_breweries"
BRONZE_PARTITIONS = ["ingestion_date"]
SILVER_PARTITIONS = ["country", "state_province"]

SILVER = StructType([BRONZE["ingestion_timestamp"], *(RECORD[name] for name in SILVER_FIELDS)])
GOLD = StructType([*(RECORD[name] for name in GOLD_KEYS), *table(f"{GOLD_COUNT} bigint")])
QUARANTINE = table("status string, ingestion_timestamp timestamp, payload string")
