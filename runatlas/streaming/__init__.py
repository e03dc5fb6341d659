"""Structured Streaming jobs over the prediction-event log."""
