"""All queries of this subpackage: importing its modules registers them."""

from corpusloom.llm import (  # noqa: F401
    encoding,
    formatting,
    language,
    lookalike,
    mixing,
    personal,
    quality,
    scanned,
    splitting,
    survivor,
)
from corpusloom.llm.registry import ORACLE, QUERIES  # noqa: F401
