"""DataFrame -> DataFrame operators."""

from martspark.operators.dedup import keep_first, latest_per_key, priority_rank  # noqa: F401
from martspark.operators.merge import upsert  # noqa: F401
from martspark.operators.surrogate import assign_surrogate  # noqa: F401
from martspark.operators.series import (  # noqa: F401
    date_series, date_series_between, month_series_between, calendar, last_n_months,
)
