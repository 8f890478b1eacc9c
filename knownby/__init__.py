"""knownby: point-in-time evidence processing as PySpark DataFrame pipelines."""

__version__ = "0.1.0"
