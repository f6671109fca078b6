"""Package operators."""
