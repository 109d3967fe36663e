"""placelink: entity resolution of place observations as Spark plans."""

__version__ = "0.1.0"
