"""Column-level building blocks: rules as data, safe casts, rounding, calendar parts."""
