"""Operators of a training-data pipeline: one module each, general interfaces, no import from the rest."""
