"""Change-data landing on Spark: decode change events, type them, land them, read them back."""

__version__ = "0.1.0"
