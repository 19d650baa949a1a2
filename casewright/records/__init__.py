"""Whole case records, nested: schema, sanitising, gates, validation, resolution, identity, state and sinks."""
