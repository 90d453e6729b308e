"""Column expressions that take an OCPP log line apart.

A log line holds a time text and one OCPP-J frame::

    <dd-MMM-yyyy HH:mm:ss.SSS> [2,"<id>","<Action>",{...}]@@EOM@@   call (request)
    <dd-MMM-yyyy HH:mm:ss.SSS> [3,"<id>",{...}]@@EOM@@              call result (response)
    <dd-MMM-yyyy HH:mm:ss.SSS> [4,"<id>","<code>","<text>",{...}]@@EOM@@  call error

Everything here is a built-in Spark expression (regexp_extract, split, get,
try_to_timestamp), so it runs inside whole-stage codegen, batch or stream.

Two modes:

* ``faithful`` reproduces the original pipeline's patterns and their quirks:
  the frame starts at the first ``[`` of the line, ``.`` stops at a newline,
  the message id keeps only the first digit run, the action needs a numeric
  id, and the request body accepts any quoted id.
* ``fixed`` (default) anchors the frame on ``[2,``/``[3,``/``[4,``, lets the
  body span newlines, takes the whole quoted id and reads the type, id,
  action and body from the frame text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Patterns and formats that must equal the pipeline's.
# ---------------------------------------------------------------------------

#: time text written by the charge point gateway, and its parse format
CREATED_PATTERN = r"(\d{2}-\w{3}-\d{4} \d{2}:\d{2}:\d{2}\.\d{3})"
CREATED_FORMAT = "dd-MMM-yyyy HH:mm:ss.SSS"
#: end-of-message marker
EOM = "@@EOM@@"
#: connector id as written in a body (numeric, no space after the colon)
CONNECTOR_PATTERN = r'"connectorId":(\d+)'
#: faithful-mode patterns
FAITHFUL_FRAME_PATTERN = r"\[(.*)\]@@EOM@@"
FAITHFUL_COMPONENT_SEPARATOR = ',"'
FAITHFUL_MESSAGE_ID_PATTERN = r"(\d+)"
FAITHFUL_ACTION_PATTERN = r'\[2,"\d+","(\w+)"'
FAITHFUL_REQUEST_BODY_PATTERN = r'\[2,"[^"]+","[^"]+",(\{.*\})\]@@EOM@@'
FAITHFUL_CURRENT_TIME_PATTERN = r'"currentTime":"([^"]+)"'

# ---------------------------------------------------------------------------
# fixed-mode patterns (this package's own)
# ---------------------------------------------------------------------------

FRAME_PATTERN = r'(?s)\[([234],".*)\]@@EOM@@'
TYPE_PATTERN = r"^([234]),"
MESSAGE_ID_PATTERN = r'^[234],"([^"]+)"'
ACTION_PATTERN = r'^2,"[^"]+","([^"]+)"'
REQUEST_BODY_PATTERN = r'(?s)^2,"[^"]+","[^"]+",(\{.*\})$'
RESPONSE_BODY_PATTERN = r'(?s)^3,"[^"]+",(\{.*\})$'

MODES = ("fixed", "faithful")

CALL, CALL_RESULT, CALL_ERROR = "2", "3", "4"


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def frame_text(raw_log: Column, mode: str = "fixed") -> Column:
    """Frame content between ``[`` and ``]@@EOM@@`` ('' when absent, NULL for NULL)."""
    pattern = FRAME_PATTERN if check_mode(mode) == "fixed" else FAITHFUL_FRAME_PATTERN
    return F.regexp_extract(raw_log, pattern, 1)


def frame_type(frame: Column, mode: str = "fixed") -> Column:
    """'2' call, '3' result, '4' error; '' when the frame is missing or malformed."""
    if check_mode(mode) == "fixed":
        return F.regexp_extract(frame, TYPE_PATTERN, 1)
    return F.get(F.split(frame, FAITHFUL_COMPONENT_SEPARATOR), 0)


def message_id(frame: Column, mode: str = "fixed") -> Column:
    """OCPP unique message id of the frame."""
    if check_mode(mode) == "fixed":
        return F.regexp_extract(frame, MESSAGE_ID_PATTERN, 1)
    second = F.get(F.split(frame, FAITHFUL_COMPONENT_SEPARATOR), 1)
    return F.regexp_extract(second, FAITHFUL_MESSAGE_ID_PATTERN, 1)


def action(raw_log: Column, frame: Column, mode: str = "fixed") -> Column:
    """Action name of a call frame ('' for results and errors)."""
    if check_mode(mode) == "fixed":
        return F.regexp_extract(frame, ACTION_PATTERN, 1)
    return F.regexp_extract(raw_log, FAITHFUL_ACTION_PATTERN, 1)


def request_body(raw_log: Column, frame: Column, mode: str = "fixed") -> Column:
    """JSON body of a call frame ('' when not a call)."""
    if check_mode(mode) == "fixed":
        return F.regexp_extract(frame, REQUEST_BODY_PATTERN, 1)
    return F.regexp_extract(raw_log, FAITHFUL_REQUEST_BODY_PATTERN, 1)


def response_body(frame: Column) -> Column:
    """JSON body of a call-result frame ('' when not a result)."""
    return F.regexp_extract(frame, RESPONSE_BODY_PATTERN, 1)


#: one frame with the text before it (usually its time)
SEGMENT_PATTERN = r'(?s)(.*?\[[234],".*?\]@@EOM@@)'
#: type code of a frame opening
FRAME_KIND_PATTERN = r'\[([234]),"'


def found_segments(raw_log: Column) -> Column:
    """The line's frames, each with the text before it; empty for a line without a frame."""
    return F.regexp_extract_all(raw_log, F.lit(SEGMENT_PATTERN), F.lit(1))


def frame_segments(raw_log: Column, found: Column | None = None) -> Column:
    """The line cut after each end-of-message marker that closes a frame; a line without a frame is one segment.

    ``found``: a column with ``found_segments(raw_log)``, so that the pattern runs once."""
    found = found_segments(raw_log) if found is None else found
    return F.when(F.size(found) > 0, found).otherwise(F.array(raw_log))


def frame_kind(raw_log: Column) -> Column:
    """The type codes of a line's frames, each once, in ascending order: '2', '3', '4', '23', ... or ''.

    A cheap bronze partition value: every call frame (either mode) lies in a
    kind with a '2' and every result frame in one with a '3', so silver's two
    branches prune to the parts of bronze that they need.
    """
    codes = F.array_sort(F.array_distinct(F.regexp_extract_all(raw_log, F.lit(FRAME_KIND_PATTERN), F.lit(1))))
    return F.coalesce(F.array_join(codes, ""), F.lit(""))


def message_ids(raw_log: Column) -> Column:
    """The message ids of all frames of a line (array)."""
    return F.regexp_extract_all(raw_log, F.lit(r'\[[234],"([^"]+)"'), F.lit(1))


def created_text(raw_log: Column) -> Column:
    """Gateway time text of the line ('' when absent)."""
    return F.regexp_extract(raw_log, CREATED_PATTERN, 1)


def parse_created(text: Column, log_tz: str | None = None) -> Column:
    """Gateway time text → TIMESTAMP; NULL (not an error) when unparsable, ANSI or not.

    The text carries no zone. By default it is read in the session zone (the
    entry points pin UTC). ``log_tz`` names the gateway's zone instead (with
    the session zone at UTC): the wall-clock time is converted from it.
    """
    ts = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(CREATED_FORMAT))
    return ts if log_tz is None else F.to_utc_timestamp(ts, log_tz)


def connector_id(raw_log: Column) -> Column:
    """Connector id written anywhere in the line ('' when absent)."""
    return F.regexp_extract(raw_log, CONNECTOR_PATTERN, 1)


def current_time_text(response_message: Column) -> Column:
    """Faithful Heartbeat response time: raw text ('' when the key is absent)."""
    return F.regexp_extract(response_message, FAITHFUL_CURRENT_TIME_PATTERN, 1)
