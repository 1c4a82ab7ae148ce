"""Readers and writers: raw CSV, raw tables, the star-schema adapter, the stored marts."""
