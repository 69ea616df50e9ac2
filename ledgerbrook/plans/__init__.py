"""Whole jobs, and the stand-in views over the TPC-H-like tables."""

from .jobs import count_and_rank, top_words

__all__ = ["count_and_rank", "top_words"]
