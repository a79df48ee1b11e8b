"""The models, metrics and checks a user runs."""
