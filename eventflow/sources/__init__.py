"""eventflow sources."""
