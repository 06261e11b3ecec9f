"""Imports every query module so the catalog is complete."""

from rankforge.plans import catalog
from rankforge.plans import queries_core  # noqa: F401
from rankforge.plans import queries_features  # noqa: F401
from rankforge.plans import queries_joint  # noqa: F401
from rankforge.plans import queries_fit  # noqa: F401
from rankforge.plans import queries_metrics  # noqa: F401
from rankforge.plans import queries_models  # noqa: F401
from rankforge.plans import queries_samples  # noqa: F401
from rankforge.plans import queries_train  # noqa: F401
from rankforge.plans import queries_towers  # noqa: F401
from rankforge.plans import queries_trees  # noqa: F401

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES
HEADLINE = catalog.HEADLINE
