"""The layered models: staging, history, marts and analyses."""
