"""Package sources."""
