"""quillsieve: a Spark-first engine for curating annotated training data."""

__version__ = "0.1.0"
