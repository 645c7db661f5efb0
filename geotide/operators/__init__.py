"""Dataflow operators: validation, latest state, density, routing, lookups, dimensions, broadcast."""
