from tidemark.functions.columns import (
    blank_to_null,
    days_between,
    initcap_words,
    money,
    parse_ts,
    ratio,
    tidy,
    utc_wall_clock,
    whole_number,
    zip5,
)

__all__ = [
    "blank_to_null", "days_between", "initcap_words", "money", "parse_ts", "ratio", "tidy",
    "utc_wall_clock", "whole_number", "zip5",
]
