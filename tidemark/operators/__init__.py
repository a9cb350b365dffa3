"""DataFrame -> DataFrame steps from raw events to current table state."""
