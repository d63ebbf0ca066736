"""Structured Streaming: rating messages in, per-user recommendation lists out."""

from cinerank.streaming.recommender import process_batch, rating_stream, start_recommender

__all__ = ["process_batch", "rating_stream", "start_recommender"]
