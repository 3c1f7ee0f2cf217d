from letrado.functions.scalar import (  # noqa: F401
    clean_double, literate_flag, norm_text, round2, safe_double, safe_long,
    status_meta, strip_ws, target_flag,
)
