"""Whole pipelines, composed from sources and operators."""
