"""Operators for large training corpora: deduplication, filtering, extraction,
decontamination, counting and mixing. Nothing else in the library imports this
subpackage; ``queries.py`` lists its registered queries."""
