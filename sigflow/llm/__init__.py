"""Operators for preparing training corpora (see ``catalog.py`` for the registered queries)."""
