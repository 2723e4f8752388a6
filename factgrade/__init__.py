"""Grade question-answering systems for factual consistency on Spark.

Every step is a plain ``DataFrame -> DataFrame`` function built from native
column expressions.  Python runs on rows only inside the two model stages,
whose functions the caller supplies.
"""

__version__ = "0.1.0"
