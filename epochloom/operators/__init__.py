"""Relational operators: ordering, epochs, intervals, features, metrics, maps, models."""
