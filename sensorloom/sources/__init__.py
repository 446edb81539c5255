"""Readers, catalogue rules, table bindings and sinks."""
