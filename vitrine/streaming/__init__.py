"""Continuous loading of the raw layer."""
