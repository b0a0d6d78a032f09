"""starflow: daily dimensional loads for retail data, written as Spark DataFrame jobs.

``sources`` lands and publishes partitioned tables, ``operators`` holds the
dimension, fact, summary, profiling and checking operators, ``functions`` the
column expressions they share, and ``plans`` the retail model built from them.
"""
