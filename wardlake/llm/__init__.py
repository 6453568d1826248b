"""Operators for training data, their queries and SQL twins."""

from wardlake.llm import queries  # noqa: F401
from wardlake.llm.registry import QUERIES  # noqa: F401
