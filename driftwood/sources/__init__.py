"""driftwood.sources."""
