"""Schema analytics, mapping, checks and text tables for JSON document collections on Spark."""
