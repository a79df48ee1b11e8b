"""Column expressions used by the models."""
