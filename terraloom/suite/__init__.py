"""Registered queries with their oracle SQL, over the driver's tables."""

from terraloom.suite import archive, catalog, files, gaps, grids, neighbours, reports, stores, summaries
from terraloom.suite.registry import ORACLES, QUERIES


def all_queries():
    return QUERIES


def all_oracles():
    return ORACLES
