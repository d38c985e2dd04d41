"""Structured Streaming variants of the batch operators."""

from brightwash.streaming.reviews import new_reviews, review_stream, start_keyed_dedup, start_review_dedup

__all__ = ["new_reviews", "review_stream", "start_keyed_dedup", "start_review_dedup"]
