"""Property test: render a frame from random fields, parse it back (fixed mode)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import bronze_rows
from voltstream.operators import silver

ids = st.text(alphabet=st.characters(blacklist_characters='"\\\n\r', blacklist_categories=("Cs",)), min_size=1, max_size=12)
actions = st.sampled_from(["Heartbeat", "StartTransaction", "StopTransaction", "StatusNotification", "Authorize"])
values = st.one_of(st.integers(-10**6, 10**6), st.text(alphabet="abc XYZ[]{},:\n", max_size=10), st.booleans())
bodies = st.dictionaries(st.sampled_from(["connectorId", "idTag", "status", "info", "x"]), values, max_size=4)
prefixes = st.sampled_from(["", "[gw] ", "node[3] x ", "01-Jan-2024 10:00:00.000 "])
kinds = st.sampled_from(["2", "3", "4"])


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(kinds, ids, actions, bodies, prefixes, st.booleans()), min_size=30, max_size=60))
def test_render_parse_roundtrip(spark, cases):
    logs, expected = [], []
    for kind, mid, act, body, prefix, pretty in cases:
        text = json.dumps(body, indent=1 if pretty else None, separators=None if pretty else (",", ":"))
        if kind == "2":
            frame = f'2,"{mid}","{act}",{text}'
        elif kind == "3":
            frame = f'3,"{mid}",{text}'
        else:
            frame = f'4,"{mid}","GenericError","oops",{text}'
        logs.append(f"{prefix}[{frame}]@@EOM@@")
        expected.append((kind, mid, act if kind == "2" else "", text if kind == "2" else "",
                         text if kind == "3" else "", frame))
    b = bronze_rows(spark, [(i, "CS1", log) for i, log in enumerate(logs)])
    got = silver.parse_frames(b).orderBy("id").select(
        "_frame_type", "OCPP_MESSAGE_UNIQUE_ID", "OCPP_ACTION", "_request_body", "_response_body",
        "OCPP_REQUEST_MESSAGE", "OCPP_RESPONSE_MESSAGE").collect()
    for row, (kind, mid, act, req, res, frame) in zip(got, expected):
        assert row["_frame_type"] == kind
        assert row["OCPP_MESSAGE_UNIQUE_ID"] == mid
        assert row["OCPP_ACTION"] == act
        assert row["_request_body"] == req
        assert row["_response_body"] == res
        assert row["OCPP_REQUEST_MESSAGE"] == (frame if kind == "2" else None)
        assert row["OCPP_RESPONSE_MESSAGE"] == (frame if kind == "3" else None)
