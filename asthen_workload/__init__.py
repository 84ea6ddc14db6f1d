"""The test tables dressed as raw tables, the registered queries and their SQL."""
