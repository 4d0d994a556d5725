"""Incremental ingest of landed files."""

from tidelake.streaming.ingest import add_new_rows, ingest_feed
from tidelake.streaming.landed import Taken, take_landed

__all__ = ["Taken", "add_new_rows", "ingest_feed", "take_landed"]
