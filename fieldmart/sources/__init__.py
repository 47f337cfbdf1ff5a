"""Sources and sinks: table readers, SQL text reads, mart writers."""
