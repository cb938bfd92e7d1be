"""All queries of the core: importing its modules registers them."""

from corpusloom.plans import core_queries  # noqa: F401
from corpusloom.plans.registry import ORACLE, QUERIES  # noqa: F401
