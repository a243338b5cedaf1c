"""Declared schemas of topics and dimension tables.

Nothing is inferred: a stream can start before its first file exists, and a dimension
costs no extra scan.
"""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema; unlike DDL it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Field names and types of the two message formats. Money is read as double, so that
# cents survive until silver turns them into decimals.
SALES_TRANSACTION = schema_of("""
    transaction_id string, timestamp string,
    drug_id string, drug_name string, drug_category string, drug_type string,
    region_id string, region_name string, zone string, tier string, channel string,
    quantity_sold int, unit_price double, returns int, revenue double,
    cold_chain_required boolean, is_generic boolean, manufacturer string,
    ingestion_source string, ingestion_timestamp string
""")

SENSOR_READING = schema_of("""
    reading_id string, machine_id string, machine_name string, machine_type string,
    location string, timestamp string,
    temperature double, vibration double, pressure double, rpm double, voltage double,
    degradation_factor double, is_degrading boolean, will_fail_in_4hrs boolean,
    ingestion_source string, ingestion_timestamp string
""")

# Columns of the dimension files.
DRUG_MASTER = schema_of("""
    drug_id string, drug_name string, category string, drug_type string,
    shelf_life_months int, cold_chain_required boolean, is_generic boolean,
    manufacturer string, unit_price double
""")

REGION_MASTER = schema_of("""
    region_id string, region_name string, state string, zone string, tier string,
    population_proxy int, num_hospitals int, num_clinics int
""")

SEASONAL_EVENTS = schema_of("""
    event_id string, event_name string, event_type string, demand_impact string,
    affected_zones string, affected_drug_categories string, start_date date, end_date date
""")

MACHINE_MASTER = schema_of("""
    machine_id string, machine_name string, machine_type string, location string,
    manufacturer string, installation_date date, age_years double, criticality string,
    temp_min double, temp_max double, temp_critical double,
    vibration_min double, vibration_max double, vibration_critical double,
    pressure_min double, pressure_max double, pressure_critical double,
    rpm_min double, rpm_max double, rpm_critical double,
    voltage_min double, voltage_max double, voltage_critical double
""")

FAILURE_HISTORY = schema_of("""
    failure_id string, machine_id string, machine_type string, failure_date date,
    failure_type string, downtime_hours double, repair_cost_usd double, root_cause string
""")


def with_columns(schema: T.StructType, columns: str) -> T.StructType:
    """A schema extended by further columns."""
    return T.StructType([*schema.fields, *schema_of(columns).fields])


# What the bronze jobs write, and so what the silver streams read.
SALES_BRONZE = with_columns(SALES_TRANSACTION, """
    kafka_timestamp timestamp, bronze_ingested_at timestamp, source_system string, ingestion_date date
""")
SENSOR_BRONZE = with_columns(SENSOR_READING, """
    bronze_ingested_at timestamp, source_system string, ingestion_date date
""")
