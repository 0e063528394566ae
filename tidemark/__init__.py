"""Tidemark: a medallion data lake for a retail chain, written as Spark jobs."""

from tidemark.lake import Lake
from tidemark.session import build_session

__all__ = ["Lake", "build_session"]
