"""wakeline: position-tracking stream analytics expressed as Spark DataFrame plans.

Every operator is a DataFrame -> DataFrame function. The same functions run in
batch and inside Structured Streaming micro-batches (see ``wakeline.streaming``).
"""

__version__ = "0.1.0"
