"""Point-in-time analytics over operational tables, as plain Spark DataFrame code."""
