"""Raw tables, reference data and table sinks."""
