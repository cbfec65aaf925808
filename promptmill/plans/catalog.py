"""All registered queries; importing this module fills the registry."""

from promptmill.plans import (clean_queries, compat_queries, pool_queries,  # noqa: F401
                              rewrite_queries, run_queries, sampling_queries, screening_queries, source_queries,
                              stream_queries, text_queries, upkeep_queries)
from promptmill.plans.registry import REGISTRY  # noqa: F401
