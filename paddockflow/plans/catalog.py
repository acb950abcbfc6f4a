"""All registered queries with their check SQL."""

from __future__ import annotations

from paddockflow.plans import live, packets, serving, streams  # noqa: F401  (they register)
from paddockflow.plans.batch import ORACLES, QUERIES
from paddockflow.session import pin_utc


def _in_utc(function):
    def run(spark, sf_dir):
        return function(pin_utc(spark), sf_dir)

    run.__doc__ = function.__doc__
    return run


def queries():
    return {name: _in_utc(function) for name, function in QUERIES.items()}


def oracle_sql():
    return dict(ORACLES)
