"""Feedback triage on Spark: prompts, model calls, reply cleaning and typed results as DataFrames."""

from tributary.plans.classifier import Classifier

__all__ = ["Classifier"]
