"""folioflow: document-corpus preparation, indexing, retrieval and evaluation as Spark jobs."""

__version__ = "0.1.0"
