"""Structured Streaming: file ingest into bronze / master, and the incremental
bronze → gold path (stream-stream pairing, foreachBatch MERGE)."""
