"""Event logs as streams."""
