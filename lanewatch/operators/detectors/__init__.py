"""Anomaly detectors over an entity feature matrix."""
