"""Readers, sinks, literal frames and schema clones."""

from veritab.sources.frames import (  # noqa: F401
    cache_for_passes, empty_frame, literal_frame, release, schema_clone,
)
from veritab.sources.readers import (  # noqa: F401
    read_driver_table, read_jdbc, read_table, row_count,
)
from veritab.sources.sinks import append_rows, insert_into, recreate_table  # noqa: F401
