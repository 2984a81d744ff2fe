"""Operators for preparing training data: search, deduplication, archives, tokens, screening.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries`` applies them to the whole tables of the driver.
"""
