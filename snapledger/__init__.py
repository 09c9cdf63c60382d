"""Snapshot analytics on Spark: feeds, snapshots, cleansing, star schema, checks."""

from snapledger.session import build_session, shared_dir, use_utc

__all__ = ["build_session", "shared_dir", "use_utc"]
