from .casts import legacy_integral, parse_date, safe_ratio, to_type
from .values import integral_bucket, swap_values

__all__ = ["legacy_integral", "parse_date", "safe_ratio", "to_type",
           "integral_bucket", "swap_values"]
