"""Subpackage of corpusweave; see the README for the list of operators."""
