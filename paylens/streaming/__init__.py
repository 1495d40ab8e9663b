"""Structured Streaming: the ingest job, and sender sessions."""

from paylens.streaming.ingest import start_stream_ingest
from paylens.streaming.sessions import open_sessions, sender_sessions, start_session_stream

__all__ = ["open_sessions", "sender_sessions", "start_session_stream", "start_stream_ingest"]
