"""Incremental indexing of a digital-object repository, expressed as Spark DataFrame jobs."""

from shelfmark.config import CORRECTED, REFERENCE, PipelineConfig
from shelfmark.session import get_spark

__all__ = ["CORRECTED", "REFERENCE", "PipelineConfig", "get_spark"]
