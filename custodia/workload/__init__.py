"""Registered queries over the given tables."""

from custodia.workload import (  # noqa: F401
    access,
    audit,
    basics,
    coverage,
    discovery,
    privacy,
    quality,
    semantics,
    streams,
    texts,
)
from custodia.workload.registry import ORACLES, QUERIES  # noqa: F401
