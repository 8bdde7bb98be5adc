"""Training-data operators: packing, filtering, near-duplicates, search, token output.

Nothing else in the library imports this subpackage.
"""
