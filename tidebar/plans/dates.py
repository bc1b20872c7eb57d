"""The columns of each query that are dates.

Results give them as timestamps at midnight on both sides, as engines hand out dates in different types.
"""

DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "active_contract_by_volume": ("date",),
    "active_contract_rolls": ("roll_date",),
    "active_contract_range_join": ("date",),
    "avg_volume_lookback": ("date",),
    "business_calendar": ("date",),
    "combined_inventory": ("first_date", "last_date",),
    "continuous_inventory": ("first_date", "last_date",),
    "continuous_mapping": ("date",),
    "continuous_nth": ("date",),
    "contract_chain": ("last_date",),
    "contract_codes": ("month",),
    "contract_details": ("first_date", "last_date",),
    "contract_span": ("first_date", "last_date",),
    "daily_open_close": ("date",),
    "date_difference": ("date",),
    "date_intersection": ("date",),
    "expected_expiries": ("expiry",),
    "export_daily_closes": ("date",),
    "fill_by_reference_ratio": ("date",),
    "fill_zero_prices": ("date",),
    "fix_contract_expiration": ("expiry",),
    "gaps_basic": ("gap_start", "gap_end",),
    "gaps_holiday_aware": ("gap_start", "gap_end",),
    "gaps_weekend_aware": ("gap_start", "gap_end",),
    "higher_only_days": ("date",),
    "holiday_label": ("date",),
    "holiday_range_join": ("gap_start", "gap_end",),
    "incremental_start": ("start",),
    "inferred_holidays": ("date",),
    "mapping_asof": ("date",),
    "missing_business_days": ("date",),
    "missing_dates_anti": ("date",),
    "missing_vs_reference": ("date",),
    "near_roll": ("next_roll",),
    "nth_active_contract": ("date",),
    "nth_weekday": ("month", "third_friday", "first_monday",),
    "position_daily": ("date",),
    "preferred_roll_dedup": ("roll_date",),
    "price_asof_roll": ("roll_date",),
    "purge_candidates": ("first_date", "last_date",),
    "recent_gaps": ("gap_start", "gap_end",),
    "resample_last_daily": ("date",),
    "roll_calendar_offsets": ("roll_date",),
    "roll_dates_summary": ("first_roll", "last_roll",),
    "roll_pairs": ("roll_date",),
    "roll_prices": ("roll_date",),
    "rollover_context": ("roll_date",),
    "rollovers_in_range": ("roll_date",),
    "rolls_auto": ("expiry_month", "roll_date", "expiration_date",),
    "rolls_calendar": ("expiry_month", "roll_date",),
    "rolls_last_window": ("roll_date",),
    "rolls_open_interest": ("expiry_month", "roll_date", "expiration_date",),
    "rolls_volume": ("expiry_month", "roll_date", "expiration_date",),
    "rule_expiry": ("expiry",),
    "series_completeness": ("date",),
    "series_source_union": ("date",),
    "session_stats": ("date",),
    "source_consistency": ("date",),
    "stale_symbols": ("first_date", "last_date",),
    "symbol_interval_inventory": ("first_date", "last_date",),
    "symbol_inventory": ("first_date", "last_date",),
    "term_structure_spreads": ("date",),
    "trades_daily": ("date",),
    "trading_day_gaps": ("gap_start", "gap_end",),
    "trading_day_ordinal": ("last_date", "shifted",),
    "valid_trading_days": ("date",),
    "verify_rollovers": ("date",),
    "vix_settlement_calendar": ("month", "settlement", "last_trading_day",),
    "wide_outer_merge": ("date",),
}
