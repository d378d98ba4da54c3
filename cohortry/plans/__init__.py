"""Whole studies: configuration, and the chain from source tables to results."""
