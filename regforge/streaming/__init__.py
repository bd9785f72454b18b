"""Incremental landing of registry pages."""
