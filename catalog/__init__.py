"""The queries behind ``__spark_entry__``: Spark callables with independent SQL beside them."""
