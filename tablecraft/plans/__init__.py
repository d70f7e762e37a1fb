"""Registered queries with their oracle SQL."""

from tablecraft.plans import (  # noqa: F401
    basics,
    catalogs,
    checks,
    edges,
    history,
    intervals,
    merges,
    regression,
    scalars,
    stars,
    vaults,
    windows,
)
from tablecraft.plans.registry import ORACLES, QUERIES  # noqa: F401
