"""Jobs composed from the operators (batch insights, delivery check) and the
named query set (``cartwheel.plans.queries``)."""

from cartwheel.plans.etl import compute_insights, insights_from, stage_events  # noqa: F401
from cartwheel.plans.etl import run as run_etl  # noqa: F401
from cartwheel.plans.verify import check as delivery_check  # noqa: F401
from cartwheel.plans.verify import monitor  # noqa: F401
