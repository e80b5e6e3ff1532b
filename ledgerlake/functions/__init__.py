"""Domain functions: every one returns a built-in Spark ``Column``."""

from .calendar import (
    BR_HOLIDAYS_2024,
    business_days_between,
    business_days_exact,
    easter_date,
    holidays_between,
    is_business_day,
    is_national_holiday,
    is_weekend,
    national_holidays,
    time_frame,
    holiday_calendar,
    week_index,
    weekdays_between,
    with_business_days,
)
from .finance import (
    blended_mdr_pct,
    calculate_mdr,
    classify_risk_bacen,
    collateral_coverage_ratio,
    dec,
    dpd_bucket,
    expected_loss,
    format_brl,
    is_npl,
    is_written_off_by_rule,
    mdr_amount,
    monthly_to_annual_rate,
    net_amount,
    payment_method_label,
    provision_rate,
    risk_level_num,
    risk_level_order,
    exact_ratio,
    money_per_count,
    from_unscaled,
    money_sum,
    unscaled,
    money_ratio,
    safe_divide,
)
from .keys import format_value, surrogate_key
from .text import clean, clean_lower, clean_upper, mask_pii

__all__ = [name for name in dir() if not name.startswith("_")]
