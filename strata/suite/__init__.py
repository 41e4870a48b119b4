"""The registered queries. Importing this package fills the registry."""

from strata.suite import views  # noqa: F401  (views first: the SQL of every query refers to them)
from strata.suite import analytic, checking, governed, physical, raw, star, typed  # noqa: F401
from strata.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
