"""Sources, table conformance and sinks."""
