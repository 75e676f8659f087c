from millrace.functions.clean import (
    canonical_text,
    to_binary,
    to_bool,
    to_fk_id,
    to_num,
    to_time,
    to_timestamp,
    trim_or_null,
)
from millrace.functions.codes import contact_type, cost_type, lifecycle_status, sex, weigh_type
from millrace.functions.names import (
    fallback_key,
    farm_slug,
    json_cell,
    lower_name,
    synthetic_email,
    synthetic_username,
    upper_name,
)

__all__ = [
    "canonical_text",
    "contact_type",
    "cost_type",
    "fallback_key",
    "farm_slug",
    "json_cell",
    "lifecycle_status",
    "lower_name",
    "sex",
    "synthetic_email",
    "synthetic_username",
    "to_binary",
    "to_bool",
    "to_fk_id",
    "to_num",
    "to_time",
    "to_timestamp",
    "trim_or_null",
    "upper_name",
    "weigh_type",
]
