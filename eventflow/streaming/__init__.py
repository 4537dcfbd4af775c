"""eventflow streaming."""
