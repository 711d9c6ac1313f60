"""Whole tables composed from the operators: landing, silver and the reports."""
