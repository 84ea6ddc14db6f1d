"""Structured Streaming version of the daily rollup."""
