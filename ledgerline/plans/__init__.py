"""Logical plans of the pipeline: quality, dimensions, fact, star, marts, reconciliation."""
