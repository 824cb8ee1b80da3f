"""ST10: keep a stream running -- restart after a failure, 5 s apart.

The checkpoint makes a restart resume where the failed run stopped.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    delay_seconds: float = 5.0,
    max_attempts: int | None = None,
) -> int:
    """Run ``start()`` until its query ends normally.  Returns the number of
    restarts.  ``max_attempts=None`` restarts without limit."""
    restarts = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException as err:
            restarts += 1
            log.error("stream failed (restart %d): %s", restarts, err)
            if max_attempts is not None and restarts >= max_attempts:
                raise
            time.sleep(delay_seconds)
