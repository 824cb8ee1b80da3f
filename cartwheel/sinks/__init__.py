"""Writers: single-file insight outputs, catalog tables, key-value upserts."""
