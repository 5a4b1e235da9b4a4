"""Incremental (stream-driven) form of the load audit."""

from tallyspark.streaming.landing_audit import audit_landing_stream, read_stream_audit

__all__ = ["audit_landing_stream", "read_stream_audit"]
