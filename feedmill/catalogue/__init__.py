"""Every operator as a query over the shared test tables, with its SQL twin.

Stages and cores are derived from whole tables by plain SQL that both engines
read; the operator under test is the library's DataFrame code on one side and
independent SQL on the other.
"""

from feedmill.catalogue import basics, feeds, merges, plant, prices
from feedmill.catalogue.base import Query

QUERIES: dict[str, Query] = {
    q.name: q
    for module in (basics, merges, plant, prices, feeds)
    for q in module.QUERIES
}

__all__ = ["QUERIES", "Query"]
