"""waymark: trip-style records to model-ready feature tables, as Spark jobs."""

__version__ = "0.1.0"
