from marginalia.functions.columns import (  # noqa: F401
    as_date, blank_as_null, c, day_diff, domain_label, gid_to_long, in_months, micros, money,
    month_diff, month_start, monday_week, norm_key, nz, regex_group_or_null,
    round_half_away, round_to_long, safe_div, sql_round_half_away, sunday_week, try_double, try_long, utm_param,
    zero_as_null,
)
