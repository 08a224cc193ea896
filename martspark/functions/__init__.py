"""Column -> Column functions (JVM-side, codegen'd; no Python UDFs)."""

from martspark.functions.clean import (  # noqa: F401
    blank_to_null, empty_to_null, sentinel_to_null, parse_flag, parse_money,
    parse_decimal, is_numeric_text, parse_timestamp, parse_date, normalize_code,
    DISCONTINUED_FLAGS, BESTSELLER_FLAGS, KF_FLAGS,
)
from martspark.functions.keys import hash_key  # noqa: F401
from martspark.functions.dates import (  # noqa: F401
    month_start, months_back, first_day_of_month, last_day_of_month, lookback_start, ntz_lit,
)
from martspark.functions.amounts import exact_product  # noqa: F401
