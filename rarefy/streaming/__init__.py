from .score_stream import stream_score  # noqa: F401
