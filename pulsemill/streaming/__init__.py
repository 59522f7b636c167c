from pulsemill.streaming.ingest import append_raw, latest_state, read_raw, read_rejects, stream_files

__all__ = ["append_raw", "latest_state", "read_raw", "read_rejects", "stream_files"]
