"""quillfold: document intelligence over whole corpora, as Spark DataFrame operators."""

__version__ = "0.1.0"
