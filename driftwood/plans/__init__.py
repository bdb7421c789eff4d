"""driftwood.plans."""
