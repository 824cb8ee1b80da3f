"""cartwheel: commerce-event analytics written as Spark DataFrame and
Structured Streaming functions.

Every operator is a plain ``DataFrame -> DataFrame`` function; the batch job
(``plans.etl``), the trending stream (``streaming.trending``) and the delivery
check (``plans.verify``) are compositions of them.
"""

from cartwheel.config import build_session, shared_dir  # noqa: F401
from cartwheel.schema import EVENT_SCHEMA, ITEM_SCHEMA  # noqa: F401

__all__ = ["build_session", "shared_dir", "EVENT_SCHEMA", "ITEM_SCHEMA"]
