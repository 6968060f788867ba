"""Query catalogue: importing this package registers every query."""

from tessera.plans import (  # noqa: F401
    across_plans,
    embed_eval_plans,
    extract_plans,
    hierarchy_plans,
    large_id_plans,
    quality_plans,
    run_plans,
    search_plans,
    table_plans,
)
from tessera.plans import maintenance_plans  # noqa: E402, F401 — restates oracles registered above
from tessera.plans.registry import ORACLES, QUERIES  # noqa: F401
