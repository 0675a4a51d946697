"""Streaming forms of the batch operators.

The reference has no streaming code (no watermark, window, state or late
data), so nothing here is owed. The per-user statistics are plain
aggregates, so the same operator runs unchanged on an append-only log read
with ``readStream``; ``user_stats_stream`` shows that form.
"""

from shopsignal.streaming.user_stats import user_stats_stream  # noqa: F401
