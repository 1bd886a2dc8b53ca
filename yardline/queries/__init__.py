"""Registered queries over the test tables, each beside its reference SQL where SQL can say it."""

from yardline.queries import (  # noqa: F401
    aggregates,
    builders,
    features,
    io,
    joins,
    models,
    ratings,
    rows,
    scalars,
    windows,
)
from yardline.queries.registry import ORACLES, QUERIES  # noqa: F401
