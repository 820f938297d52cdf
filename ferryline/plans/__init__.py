"""Runs built from configuration: transfers, replications, steps, API extracts."""
