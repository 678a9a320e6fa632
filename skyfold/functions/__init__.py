"""Column expressions: built-in Spark functions only, so they stay inside
whole-stage code generation."""

from skyfold.functions.scalar import (  # noqa: F401
    local_date, scale_round, slot, trim_upper, utc_date_of_epoch, utc_day, variant_slot,
)
from skyfold.functions.labels import (  # noqa: F401
    bucketize, code_label, equals_label, first_match,
)
from skyfold.functions.aggregates import avg_2dp  # noqa: F401
