from lakemart.functions.expressions import (
    discount_amount,
    guarded_ratio,
    net_revenue,
    readable_size,
    safe_ratio,
)

__all__ = [
    "discount_amount",
    "guarded_ratio",
    "net_revenue",
    "readable_size",
    "safe_ratio",
]
