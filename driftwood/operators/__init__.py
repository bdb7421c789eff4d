"""driftwood.operators."""
