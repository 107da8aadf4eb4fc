"""Training-data operators: deduplication, token output, filtering and archives.

Each module holds one operator and the thin query ``opN_<name>`` that applies it to a
whole table; ``catalog.py`` registers the queries and their oracle SQL.  Nothing outside
this subpackage imports it (``__spark_entry__`` adds its queries when it is present).
"""
