"""Registered queries: each operator run over the given tables, with its SQL twin."""
