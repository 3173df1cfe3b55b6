"""Structured Streaming forms of the batch jobs.

The reference has no streaming program; the one job that naturally grows
with new input — word frequencies over text files — is offered here as an
incremental query over a folder, using the very same column expressions
as the batch job.
"""

from .words import stream_word_counts

__all__ = ["stream_word_counts"]
