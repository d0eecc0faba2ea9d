"""Pipelines assembled from the operators, broadcast size checks and lineage cuts."""
