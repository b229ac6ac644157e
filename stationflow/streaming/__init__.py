"""Structured Streaming queries: alerts, sliding windows (update and append),
and the raw archive, all off one decoded reading stream."""
