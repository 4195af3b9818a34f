"""Training-data operators: deduplication, filtering, mixing, packing, search and scoring.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.ORACLE`` register one query per operator over the driver's tables.
"""
