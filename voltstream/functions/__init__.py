"""Column expressions: OCPP frame parsing and payload schemas."""

from voltstream.functions import frames  # noqa: F401
