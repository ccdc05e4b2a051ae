"""All registered queries and their SQL."""

from __future__ import annotations

from pressgauge.plans import more_queries
from pressgauge.plans.oracles import ORACLES as _FIRST, _statement
from pressgauge.plans.queries import QUERIES, weighted_sentiment

__all__ = ["ORACLES", "QUERIES", "ROWS_ONLY", "weighted_sentiment"]

ORACLES = {**_FIRST, **{name: _statement(body) for name, body in more_queries.BODIES.items()}}
#: No SQL counterpart.
ROWS_ONLY = {"credibility_train", "credibility_score", *more_queries.ROWS_ONLY}
