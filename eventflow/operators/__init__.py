"""eventflow operators."""
