"""Threadlytics: DataFrame operators for threaded discussions about assets.

normalise -> extract -> inherit -> deduplicate -> aggregate -> report, in batch
and, through Structured Streaming, incrementally.
"""

__version__ = "0.1.0"
