"""The bronze load as a stream over landing snapshots."""

from hearthlake.streaming.bronze import follow_snapshots

__all__ = ["follow_snapshots"]
