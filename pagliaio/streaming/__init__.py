from pagliaio.streaming.observe import deduplicated, observe_stream, sessions, upsert_sink, windowed_counts

__all__ = ["deduplicated", "observe_stream", "sessions", "upsert_sink", "windowed_counts"]
