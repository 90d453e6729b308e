"""Table and payload schemas.

Fixed values: table column names, their order and types must equal the
pipeline's published table layouts (including the spelling
``HEARBEAT_INTERVAL``), so they are spelled out below as DDL text.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# Table layouts
# ---------------------------------------------------------------------------

#: columns of the raw OCPP CSV as read into bronze (reader schema)
BRONZE_INPUT_DDL = """
id BIGINT,
request_uuid STRING,
request_date TIMESTAMP,
entity_id BIGINT,
service_provider_id BIGINT,
raw_log STRING,
serial_number STRING,
identity_key STRING,
_rescued_data STRING
"""

#: bronze table (reader columns + ingest metadata)
BRONZE_DDL = """
id BIGINT,
request_uuid STRING,
request_date TIMESTAMP,
entity_id BIGINT,
service_provider_id BIGINT,
raw_log STRING,
serial_number STRING,
identity_key STRING,
source_file STRING,
ingest_load_timestamp TIMESTAMP,
_rescued_data STRING
"""

#: station master data, one row per connector, all text
MASTER_DDL = """
OCPP_CHARGE_STATION_ID STRING,
OCPP_CONNECTOR_ID STRING,
CONNECTOR_ID STRING,
SOURCE_EVSE_ID STRING,
COUNTRY_CODE STRING,
SITE_ID STRING,
SITE_NAME STRING,
LOCATION_TYPE STRING,
LOCATION_SUB_TYPE STRING,
TIMEZONE STRING,
LOCATION_STATUS STRING,
OPERATOR STRING,
OWNING_COMPANY STRING,
OCPI_CONNECTOR_ID STRING,
CONNECTOR_TYPE STRING,
POWER_TYPE STRING,
POWER_KW STRING,
VOLTAGE STRING,
AMPERAGE STRING,
MANUFACTURER STRING,
MODEL STRING,
_rescued_data STRING
"""

#: silver table (44 columns)
SILVER_DDL = """
SOURCE STRING,
SOURCE_ID STRING,
SOURCE_MESSAGE_ID STRING,
CHARGE_STATION_ID STRING,
MANUFACTURER STRING,
MODEL STRING,
SERIAL_NUMBER STRING,
FIRMWARE_VERSION STRING,
COUNTRY_CODE STRING,
INGEST_LOAD_TIMESTAMP TIMESTAMP,
STAGE_LOAD_TIMESTAMP TIMESTAMP,
SOURCE_MESSAGE_TIMESTAMP_CREATED TIMESTAMP,
SOURCE_MESSAGE_TIMESTAMP_UPDATED TIMESTAMP,
CORE_MESSAGE_UNIQUE_ID STRING,
UNIFIED_TIMESTAMP TIMESTAMP,
UNIFIED_TIMESTAMP_SOURCE STRING,
OCPP_MESSAGE_UNIQUE_ID STRING,
OCPP_ACTION STRING,
OCPP_REQUEST_MESSAGE STRING,
OCPP_RESPONSE_MESSAGE STRING,
SOURCE_CONNECTOR_ID STRING,
OCPP_ERROR_CODE STRING,
VENDOR_ERROR_CODE STRING,
STATUS STRING,
PAYLOAD_TIMESTAMP TIMESTAMP,
ID_TAG STRING,
ID_TAG_STATUS STRING,
TRANSACTION_ID INT,
STOP_REASON STRING,
METER_START FLOAT,
METER_STOP FLOAT,
CHANGE_AVAILABILITY_TYPE STRING,
CHANGE_AVAILABILITY_STATUS STRING,
HEARBEAT_INTERVAL INT,
METERVALUE_SOC FLOAT,
METERVALUE_CURRENT_OFFERED FLOAT,
METERVALUE_CURRENT_IMPORT FLOAT,
METERVALUE_POWER_KW FLOAT,
METERVALUE_ENERGY_KWH FLOAT,
METERVALUE_VOLTAGE FLOAT,
METERVALUE_TEMP FLOAT,
METERVALUE_RPM FLOAT,
SIM_ICCID STRING,
STATUS_INFO STRING
"""

#: gold table = silver + processing stamp (45 columns)
GOLD_DDL = SILVER_DDL.rstrip() + ",\nSTAGE_PROCESSED_TIMESTAMP TIMESTAMP\n"

#: logical key of silver / gold rows
GOLD_KEY = ("SOURCE", "SOURCE_ID")

#: load time that the master stream adds to master rows (beside the 22 published columns)
MASTER_LOAD = "MASTER_LOAD_TIME"

# ---------------------------------------------------------------------------
# OCPP payload fields read from request and response bodies.
# Field names are the protocol's JSON keys.  Each request action reads a
# subset of the merged request schema; responses likewise.
# ---------------------------------------------------------------------------

#: one struct covering every request field, so each body is parsed once
REQUEST_PAYLOAD_DDL = (
    "timestamp TIMESTAMP, connectorId STRING, vendorId STRING, info STRING, "
    "errorCode STRING, status STRING, vendorErrorCode STRING, idTag STRING, "
    "meterStart STRING, meterStop STRING, transactionId STRING, reason STRING, "
    "transactionData ARRAY<STRING>"
)
#: one struct of a stop's meter readings (an element of transactionData)
TRANSACTION_DATA_FIELDS = "timestamp: TIMESTAMP, sampledValue: ARRAY<STRUCT<value: STRING, measurand: STRING, unit: STRING, context: STRING>>"
#: one struct covering every response field
RESPONSE_PAYLOAD_DDL = "currentTime TIMESTAMP, idTagInfo STRUCT<status: STRING>, transactionId STRING"


def ddl(text: str) -> str:
    """One-line DDL text, accepted by ``spark.read.schema``, ``from_json`` and ``fromDDL``."""
    return " ".join(text.split())


def struct(text: str) -> StructType:
    """``StructType`` from a DDL column list (needs an active session)."""
    return StructType.fromDDL(ddl(text))


def column_names(text: str) -> list[str]:
    """Top-level column names of a flat DDL list (no session needed)."""
    return [part.strip().split()[0] for part in ddl(text).split(",") if part.strip()]


SILVER_COLUMNS = column_names(SILVER_DDL)
GOLD_COLUMNS = column_names(GOLD_DDL)
BRONZE_COLUMNS = column_names(BRONZE_DDL)
MASTER_COLUMNS = column_names(MASTER_DDL)
