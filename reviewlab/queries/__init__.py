"""Queries over the given tables, one module per part of the library."""

from reviewlab.queries import (  # noqa: F401
    drawing,
    generation,
    models,
    profiling,
    scalars,
    storage,
    texts,
)
from reviewlab.queries.registry import RUNS, SQL  # noqa: F401
