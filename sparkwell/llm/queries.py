"""Importing this module registers every query of the subpackage."""

from sparkwell.llm import queries_text, queries_vectors  # noqa: F401
from sparkwell.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
