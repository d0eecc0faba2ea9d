"""Readers, writers and the fixture mapping of the driver's tables."""
