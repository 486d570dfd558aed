"""Streaming: incremental daily refresh of the attribution table."""

from .daily import refresh_new_days

__all__ = ["refresh_new_days"]
