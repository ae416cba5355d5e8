"""Queries of the engine over the driver's tables, each beside its SQL."""
