"""Fleet operators: lazy ``DataFrame -> DataFrame`` functions."""
