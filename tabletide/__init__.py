"""tabletide: moving, checking and reshaping tables with Spark."""

__version__ = "0.1.0"
