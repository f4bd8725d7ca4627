from stratum.functions.columns import (  # noqa: F401
    avg_double,
    avg_stable,
    calendar_parts,
    canon,
    dow_sunday0,
    double_text,
    hash_key,
    hour_of_day,
    in_dates,
    is_weekend,
    iso_text,
    minute_diff,
    month_name,
    round_half_away,
    safe_ratio,
    sum_decimal,
    weekday_name,
)
