from tablewright.streaming.flatten import flatten_known, read_flattened, stream_flatten

__all__ = ["flatten_known", "read_flattened", "stream_flatten"]
