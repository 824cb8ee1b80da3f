"""Training-data operators: search, archives, packing, scans, rules, models.

Each module holds one operator with its general interface; ``queries`` holds
the registered queries.  Nothing else in the library imports this package.
"""
