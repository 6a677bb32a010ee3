"""Every operator as a query over the shared test tables, with its SQL counterpart."""

from sluiceway.catalogue import control, files, relational, responses
from sluiceway.catalogue.registry import oracles, queries

__all__ = ["control", "files", "oracles", "queries", "relational", "responses"]
