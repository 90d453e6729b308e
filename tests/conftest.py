import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from voltstream.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8, app="voltstream-tests")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_base(spark):
    from voltstream.session import run_dir

    return run_dir(spark, "test")


BRONZE_COLS = "id bigint, request_uuid string, request_date timestamp, entity_id bigint, service_provider_id bigint, " \
    "raw_log string, serial_number string, identity_key string, source_file string, " \
    "ingest_load_timestamp timestamp, _rescued_data string"


def bronze_rows(spark, rows):
    """rows: (id, identity_key, raw_log) → bronze DataFrame."""
    import datetime as dt

    full = [
        (i, f"u{i}", dt.datetime(2024, 1, 1), 7, 1, log, "SN", key, "f.csv", dt.datetime(2024, 2, 1), None)
        for i, key, log in rows
    ]
    return spark.createDataFrame(full, BRONZE_COLS)


def master_rows(spark, rows):
    """rows: (station, connector, manufacturer) → master DataFrame (22 columns)."""
    from voltstream import schemas

    cols = schemas.MASTER_COLUMNS
    out = []
    for st, conn, man in rows:
        d = {c: None for c in cols}
        d.update(OCPP_CHARGE_STATION_ID=st, OCPP_CONNECTOR_ID=f"{st}-{conn}", CONNECTOR_ID=str(conn),
                 MANUFACTURER=man, MODEL="M1", COUNTRY_CODE="LU")
        out.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(out, schemas.ddl(schemas.MASTER_DDL))
