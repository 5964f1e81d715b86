"""Composite flows (layer pipelines) and the query catalog."""
