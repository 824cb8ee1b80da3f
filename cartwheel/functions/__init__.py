"""Column-level helpers (built-in Spark expressions unless noted)."""

from cartwheel.functions.money import items_total, round2, subtotal  # noqa: F401
from cartwheel.functions.parsing import (  # noqa: F401
    inspect_json,
    is_blank,
    parse_iso_instant,
    project_stream_fields,
    strip_line,
)
from cartwheel.functions.text import (  # noqa: F401
    b64_utf8,
    iso_instant_text,
    kv_payload,
    python_text,
    trending_line,
)
