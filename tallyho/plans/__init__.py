"""Staged extract / transform / load jobs built from the operators."""
