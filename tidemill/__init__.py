"""Feature engineering and windowed analytics over transaction data, as Spark plans.

Every operator is a function from DataFrame to DataFrame: it adds to a lazy plan and runs nothing.
Column names are parameters, so operators chain with ``df.transform``.
Timestamps are read in the session time zone, which should be UTC.
"""
