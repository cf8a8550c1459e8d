"""Keeps a corpus of articles in step with its publisher, on Spark."""

from folio_sync.plans.delta_load import Options, delta_load
from folio_sync.plans.full_load import full_load
from folio_sync.plans.publish import append_articles, replace_articles, upsert_articles
from folio_sync.sources.corpus import (
    compact, initialize, read_content, read_history, read_metadata, validate,
)
from folio_sync.streaming.package_feed import package_feed

__all__ = [
    "Options", "append_articles", "compact", "delta_load", "full_load", "initialize", "package_feed",
    "read_content", "read_history", "read_metadata",
    "replace_articles", "upsert_articles", "validate",
]
