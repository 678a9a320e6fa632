"""DataFrame → DataFrame operators."""

from skyfold.operators.dedup import dedup_by, duplicate_keys  # noqa: F401
from skyfold.operators.filters import (  # noqa: F401
    all_present, in_box, require_non_null, within_box,
)
from skyfold.operators.profile import (  # noqa: F401
    loss_report, null_profile, row_count, top_k, value_counts,
)
from skyfold.operators.shape import (  # noqa: F401
    drop_columns, explode_states, map_slots, rename,
)
from skyfold.operators.upsert import (  # noqa: F401
    DuplicateSourceKeyError, unique_source, upsert,
)
