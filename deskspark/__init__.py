"""Keeps an analytic copy of service-desk data up to date with Spark."""
