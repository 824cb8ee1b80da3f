"""DataFrame -> DataFrame operators.  Jobs in ``cartwheel.plans`` and
``cartwheel.streaming`` compose them."""

from cartwheel.operators.cart import (  # noqa: F401
    cart_state,
    order_totals_from_arrays,
    order_totals_from_items,
)
from cartwheel.operators.catalog import derive_catalog  # noqa: F401
from cartwheel.operators.dedup import (  # noqa: F401
    counted_stats,
    dedup_events,
    dedup_events_counted,
    dedup_stats,
    drop_marked,
    mark_repeats,
    repeated_hashes,
    with_places,
)
from cartwheel.operators.digest import id_differences, reconcile_by_digest  # noqa: F401
from cartwheel.operators.insights import (  # noqa: F401
    abandonment,
    abandonment_by_join,
    delivery_status_counts,
    revenue_by_category,
    revenue_by_city,
)
from cartwheel.operators.items import explode_items, purchases, with_subtotal  # noqa: F401
from cartwheel.operators.kv import latest_cells, row_payloads, to_cells  # noqa: F401
from cartwheel.operators.reconcile import (  # noqa: F401
    delivery_report,
    event_type_counts,
    file_lines,
    growth_ok,
    growth_report,
    id_multiplicity,
    inspect_lines,
    reconcile_ids,
)
from cartwheel.operators.trending import (  # noqa: F401
    alert_key,
    alerts,
    stream_records,
    trending_counts,
    trending_counts_paned,
    trending_text,
)
