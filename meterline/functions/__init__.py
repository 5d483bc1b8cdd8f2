"""Column functions; all of them stay inside generated code."""

from .calendar import month_name, weekday_name
from .codes import describe, payment_description, rate_code_description, service_name, vendor_name
from .keys import surrogate_key
from .paths import file_name, path_segment, service_code_of_path

__all__ = [
    "describe",
    "file_name",
    "month_name",
    "path_segment",
    "payment_description",
    "rate_code_description",
    "service_code_of_path",
    "service_name",
    "surrogate_key",
    "vendor_name",
    "weekday_name",
]
