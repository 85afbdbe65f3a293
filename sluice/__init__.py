"""sluice: keyed event-stream operators as Spark DataFrame transforms.

Every operator is a function ``(DataFrame, ...) -> DataFrame`` (or a tuple of
frames for side outputs) that works on batch tables and, where it makes sense,
on Structured Streaming frames.
"""

__version__ = "0.1.0"
