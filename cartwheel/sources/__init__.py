"""Readers: JSON-lines events, raw text lines, catalog tables, driver tables."""

from cartwheel.sources.events import read_events  # noqa: F401
from cartwheel.sources.lines import count_files, count_lines, files_by_name, read_lines  # noqa: F401
from cartwheel.sources.tables import read_table  # noqa: F401
