"""All registered queries."""

from kerbside.plans import cleaning, explore, jobs, modelling, quality  # noqa: F401
from kerbside.plans.registry import ORACLES, QUERIES  # noqa: F401
