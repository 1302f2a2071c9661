"""Incremental runs of the batch operators with Structured Streaming.

The reference has no streaming operator; this package only runs the existing
daily aggregates (``event_rate``) over files arriving in a folder, so a daily
roll-up can be kept current without re-reading history.
"""

from batchkit.streaming.incremental import daily_event_rate_stream

__all__ = ["daily_event_rate_stream"]
