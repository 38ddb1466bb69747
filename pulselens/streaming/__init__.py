"""Structured Streaming versions of the 15-minute KPI, alert and daily ETL jobs."""
