"""Training-data operators: tokens, shards, duplicates, fingerprints, languages.

Each module holds one operator with a general interface (any id and text
column); ``queries.py`` applies them to the driver tables.  Nothing outside
this folder imports it.
"""
