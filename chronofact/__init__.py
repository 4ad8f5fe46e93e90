"""Point-in-time analytics on PySpark: versioned facts, marts, retrieval and data-quality operators."""

__version__ = "0.1.0"
