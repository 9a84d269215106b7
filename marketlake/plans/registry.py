"""Registry of the named queries (one per operator of the inventory) and their oracles."""

from __future__ import annotations

import functools

from marketlake.plans import alpaca, markets, sources, statements, streams
from marketlake.plans.oracles import ORACLES as _ORACLES
from marketlake.session import utc_session


def _in_utc(fn):
    """Each registered query is planned under a UTC session time zone (the
    tables store UTC wall clock), whatever the caller's session uses."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        with utc_session(spark):
            return fn(spark, sf_dir)
    return run


QUERIES = {}
for _mod in (alpaca, markets, sources, statements, streams):
    for _name in dir(_mod):
        if _name.startswith("q_"):
            QUERIES[_name[2:]] = _in_utc(getattr(_mod, _name))

ORACLES = {k: v for k, v in _ORACLES.items() if k in QUERIES}
