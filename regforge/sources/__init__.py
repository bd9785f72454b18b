"""Readers and flatteners. Flatteners are narrow (explode and project, no shuffle),
so they take batch and streaming DataFrames alike."""
