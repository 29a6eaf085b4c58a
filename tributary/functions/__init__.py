from .channels import CHANNELS, FEATURE_CHANNELS, channel_grouping_8, channel_grouping_19, channel_list, feature_name
from .conversion import lookback_case, value_expr, value_mode_case
from .params import event_param
from .paths import path_string, path_string_capped
from .util import dlit, nullif, safe_div, utc_date, utc_date_from_micros, whole_days, whole_hours

__all__ = [
    "CHANNELS", "FEATURE_CHANNELS", "channel_grouping_8", "channel_grouping_19", "channel_list",
    "feature_name", "lookback_case", "value_expr", "value_mode_case", "event_param", "path_string",
    "path_string_capped", "dlit", "nullif", "safe_div", "utc_date", "utc_date_from_micros",
    "whole_days", "whole_hours",
]
