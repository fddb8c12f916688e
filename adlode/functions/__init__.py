"""Column-level building blocks: text, rounding, skill matching, HTML fields."""
