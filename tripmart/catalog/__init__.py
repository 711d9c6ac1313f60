"""Registered queries: the operators run over a star schema in the role of trips."""
