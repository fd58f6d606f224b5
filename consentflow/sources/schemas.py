"""Explicit schemas of the raw tables and JSON → StructType conversion."""

from __future__ import annotations

import json

from pyspark.sql import types as T

RAW_EVENT_COLUMNS = [
    ("EVENT_ID", T.StringType()), ("USER_ID", T.StringType()), ("TYPE", T.StringType()),
    ("RATE", T.DoubleType()), ("PARAMETERS", T.StringType()), ("EVENT_TIME", T.TimestampNTZType()),
    ("WINDOW_START", T.TimestampNTZType()), ("APIKEY", T.StringType()), ("CONSENT", T.StringType()),
    ("COUNT", T.LongType()), ("EXPERIMENT", T.DoubleType()), ("SDK_TYPE", T.StringType()),
    ("DOMAIN", T.StringType()), ("DEPLOYMENT_ID", T.StringType()), ("COUNTRY", T.StringType()),
    ("REGION", T.StringType()), ("BROWSER_FAMILY", T.StringType()), ("DEVICE_TYPE", T.StringType()),
]
LINEAGE_COLUMNS = [("load_time", T.TimestampType()), ("load_no", T.StringType()),
                   ("filename", T.StringType())]

RAW_EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_EVENT_COLUMNS])

RAW_COMPANY_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in (
    "PUBLIC_API_KEY", "INDUSTRY_BACK", "INDUSTRY_FRONT", "HQ_COUNTRY")])

COUNTRY_SEED_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("alpha_2", T.StringType()),
    T.StructField("alpha_3", T.StringType()), T.StructField("country_code", T.IntegerType()),
    T.StructField("iso_3166_2", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("sub_region", T.StringType()), T.StructField("intermediate_region", T.StringType()),
    T.StructField("region_code", T.IntegerType()), T.StructField("sub_region_code", T.IntegerType()),
    T.StructField("intermediate_region_code", T.IntegerType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("load_time", T.TimestampType()),
    T.StructField("load_no", T.StringType()), T.StructField("modification_time", T.TimestampType()),
    T.StructField("length", T.LongType()),
])

# SQL type names of a column-list schema file → Spark types.
_SQL_TYPES = {
    "VARCHAR": T.StringType(), "TEXT": T.StringType(), "STRING": T.StringType(),
    "DOUBLE PRECISION": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(),
    "REAL": T.FloatType(), "BIGINT": T.LongType(), "INTEGER": T.IntegerType(), "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMPTZ": T.TimestampType(),
}


def struct_from_json(spec: str | dict) -> T.StructType:
    """``{"columns": [{"name", "type"}, ...]}`` (text or parsed) → StructType."""
    if isinstance(spec, str):
        spec = json.loads(spec)
    fields = []
    for c in spec["columns"]:
        t = c["type"].strip().upper()
        if t not in _SQL_TYPES:
            raise ValueError(f"unsupported column type {c['type']!r} for {c['name']!r}")
        fields.append(T.StructField(c["name"], _SQL_TYPES[t], True))
    return T.StructType(fields)


def struct_from_json_file(path: str) -> T.StructType:
    with open(path, encoding="utf-8") as fh:
        return struct_from_json(fh.read())
