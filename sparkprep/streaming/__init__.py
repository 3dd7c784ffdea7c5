"""Fitted models on streams."""
