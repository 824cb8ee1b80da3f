"""Structured Streaming jobs: trending windows with alerts, raw landing."""

from cartwheel.streaming.cart import current_carts, start_cart  # noqa: F401
from cartwheel.streaming.growth import GrowthStream  # noqa: F401
from cartwheel.streaming.landing import start_landing  # noqa: F401
from cartwheel.streaming.line_count import RunningLineCount  # noqa: F401
from cartwheel.streaming.restart import run_with_restarts  # noqa: F401
from cartwheel.streaming.trending import start_trending  # noqa: F401
