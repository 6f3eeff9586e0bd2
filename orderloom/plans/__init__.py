from orderloom.plans import (  # noqa: F401
    cluster_queries,
    etl_queries,
    model_queries,
    monitoring_queries,
    profile_queries,
    segment_queries,
    series_queries,
    stream_queries,
    text_queries,
)
from orderloom.plans.registry import QUERIES  # noqa: F401
