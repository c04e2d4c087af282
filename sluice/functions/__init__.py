from .casts import (NUMERIC, INT64, strict_cast, to_numeric, to_int64, to_date,
                    exact_add, exact_ratio, exact_product)
from .timez import (local_to_utc, utc_to_local_date, utc_date, is_weekend,
                    weekday_name, seconds_between)
from .text import split_codes, clip_text, path_join

__all__ = [
    "NUMERIC", "INT64", "strict_cast", "to_numeric", "to_int64", "to_date",
    "exact_add", "exact_ratio", "exact_product", "local_to_utc", "utc_to_local_date",
    "utc_date", "is_weekend", "weekday_name", "seconds_between", "split_codes",
    "clip_text", "path_join",
]
