"""Whole queries: the analysis job, task parameters, and the registered query catalogue."""
