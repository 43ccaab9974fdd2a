"""Registered queries: every operator over the given tables, beside its SQL check."""
