"""Reusable DataFrame operators behind the models."""
