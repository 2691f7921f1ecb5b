"""Operators that prepare text corpora: near duplicates, repeated passages, contamination, personal
data, licences, quality, language, and the token sequences of public vocabularies.

Each module holds one operator with its own general interface; ``queries`` applies them to the given
tables.  Operators read only the columns they name, so other columns of any name do no harm.
"""
