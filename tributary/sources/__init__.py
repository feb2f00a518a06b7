"""Inputs: taxonomies, few-shot examples and feedback tables."""
