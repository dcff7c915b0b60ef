from tidemark.streaming.incremental import stream_sync

__all__ = ["stream_sync"]
