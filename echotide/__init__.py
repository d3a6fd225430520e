"""Review-sentiment analytics on Spark: collect, clean, tag, model and measure."""

__version__ = "0.1.0"
