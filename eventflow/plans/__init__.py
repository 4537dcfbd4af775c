"""Query bindings to the driver tables, their SQL oracles, and jobs."""
