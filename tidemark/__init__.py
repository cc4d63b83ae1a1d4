"""Snapshot + change log -> current state -> star schema, as Spark jobs."""
