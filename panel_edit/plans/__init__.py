"""Composite jobs, derived fixtures and the registered query catalog."""
