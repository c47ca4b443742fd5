"""Sources and sinks: release selection, delimited extracts, ingest, writers."""
