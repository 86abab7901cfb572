"""Fleet-operations analytics on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions. Only ``sources`` and
``plans`` know about paths; nothing in ``operators`` or ``functions`` touches
storage.
"""
