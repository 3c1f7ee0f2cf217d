from letrado.operators.dedup import keep_first, keep_latest  # noqa: F401
from letrado.operators.integrity import orphans, referential_filter  # noqa: F401
from letrado.operators.reshape import fill_missing, tolerant_select, unpivot_years  # noqa: F401
