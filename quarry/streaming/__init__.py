"""Incremental (Structured Streaming) runs of the batch analyses."""

from quarry.streaming.incremental import (  # noqa: F401
    movie_state_stream,
    read_movie_stats,
    run_movie_stats,
    text_stream,
)
