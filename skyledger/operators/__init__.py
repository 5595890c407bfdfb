"""Operators over keyed hourly series: merges, aggregates, windows, checks, forecasting."""
