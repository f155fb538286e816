"""Registered queries, built from the operators."""
