from cartlake.functions.expressions import (  # noqa: F401
    bool_flag,
    date_path,
    flag_else_zero,
    flag_or_null,
    float_to_int,
    guarded_ratio,
    map_value,
    parse_pg_boolean,
    round_half_even,
)
