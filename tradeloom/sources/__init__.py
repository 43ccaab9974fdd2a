"""Landing readers, feed schemas and sinks."""
