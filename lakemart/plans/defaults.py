"""Default parameters of the query set, for its SQL and its DataFrame forms."""

import datetime as dt
from decimal import Decimal

# The constants of the named queries.
DEFAULTS = {
    # q3_top10
    "segment": "BUILDING",
    "cutoff": dt.date(1995, 3, 15),
    "top": 10,
    # q6_discount
    "start": dt.date(1994, 1, 1),
    "end": dt.date(1995, 1, 1),
    "low": Decimal("0.05"),
    "high": Decimal("0.07"),
    "quantity": 24,
}
