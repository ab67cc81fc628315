"""Values that several test files share."""

import datetime as dt

from millrace.schemas import HEADERS

STAMP = dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc)

# The pinned CSV row.
STABLE_ROW = dict(
    zip(
        HEADERS,
        [
            "123456", "Europe", "France", "Beverages", "Online", "H", "1/3/2010", "2/9/2010",
            "250", "9.99", "5.50", "2497.50", "1375.00", "1122.50",
        ],
    )
)
