"""Whole plans: layers, input bindings, the query registry and its oracles."""
