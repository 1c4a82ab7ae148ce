"""Marketplace order analytics as Spark jobs: staging, wide marts, executive KPIs, data quality."""
