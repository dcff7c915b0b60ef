"""Whole runs: published targets, the state log, sync of one or many tables, and the query catalogue."""
