"""Operators for training-data pipelines over documents, pages and labels.

Nothing else in the library imports this subpackage; its queries and their
SQL live in ``queries``."""
