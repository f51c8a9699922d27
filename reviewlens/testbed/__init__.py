"""The engine's tables mapped onto the driver's tables, the query catalogue and its SQL oracles."""
