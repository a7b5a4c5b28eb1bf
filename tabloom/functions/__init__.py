from tabloom.functions.numeric import (  # noqa: F401
    double_sql,
    entropy_term,
    half_even,
    hash_bucket,
    nan_to_null,
    quoted,
    sigmoid,
    softplus,
    weighted_sum,
)
