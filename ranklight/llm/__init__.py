"""Training-data operators: ten corpus operators, one module each.

Nothing else in the library imports this subpackage.  ``registry`` holds
their queries and DuckDB oracles; ``__spark_entry__`` adds them when the
subpackage is present.
"""
