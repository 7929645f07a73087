from reviewlens.streaming.moderation import (
    dedup_stream,
    moderate,
    run_available,
    stream_table,
    violation_counts,
)

__all__ = ["dedup_stream", "moderate", "run_available", "stream_table", "violation_counts"]
