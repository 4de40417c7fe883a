"""Operators for preparing training data: decontamination, chat collapse, packing, near-duplicate
joins, URL rules, substring removal, language and quality scoring, vector near-duplicates.

Nothing else in the library imports this subpackage; it may be removed as a whole."""
