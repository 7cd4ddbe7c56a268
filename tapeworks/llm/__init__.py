"""Training-data operators: text stores, mixing, sharding, near-duplicates, chat, search, filters, scoring.

The rest of the library does not import this subpackage.
"""
