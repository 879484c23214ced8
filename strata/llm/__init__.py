"""Training-data operators: near-duplicates, scoring, extraction, encoding, packing.

Each module holds one operator with a general interface; ``suite`` holds the
registered queries and their SQL. Nothing else in the library imports this
subpackage.
"""
