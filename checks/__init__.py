"""Runs the warehouse jobs on the shared test tables and states the expected results as SQL."""
