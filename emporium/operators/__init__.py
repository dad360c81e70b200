"""Operators: models (staging, intermediate, marts), checks, reconciliation, profiling."""
