"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from tallyweave.llm.oracles import ORACLES
from tallyweave.llm.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
