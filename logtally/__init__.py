"""Summaries of delimited transaction logs on Spark, in batch and as a stream."""

from logtally.spec import FieldSpec, SummarySpec

__all__ = ["FieldSpec", "SummarySpec"]
