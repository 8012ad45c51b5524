"""Incremental ingest: the daily file pick-up as a restartable Structured Streaming job.

The reference has no streaming; its ingest is a daily batch over a landing file. Run
with ``trigger(availableNow=True)`` the same read becomes exactly-once over new files:
each run processes only files not seen before (tracked in the checkpoint) and stops.
"""

from starmart.streaming.landing import ingest_landing

__all__ = ["ingest_landing"]
