"""Change streams: source, log sink, deduplication, continuous state."""
