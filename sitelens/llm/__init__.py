"""Operators of a training-data pipeline: near and exact de-duplication,
tokenizing, decontamination, language and quality models, URL rules, archives.

Nothing else in the library imports this package."""
