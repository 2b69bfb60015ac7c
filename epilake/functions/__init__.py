"""Column-expression builders (all JVM-side built-ins, no UDFs)."""

from epilake.functions.columns import (  # noqa: F401
    AGE_BINS,
    as_date,
    bin_label,
    normalise_code,
    rate_per_n_expr,
    round2,
)
