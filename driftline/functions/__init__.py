"""Column expressions. All of them stay inside the JVM."""

from driftline.functions.digests import row_digest
from driftline.functions.frames import frame_body, frame_magic, frame_schema_id
from driftline.functions.times import document_time, epoch_seconds, from_micros, from_millis
from driftline.functions.values import (
    clamp_at_zero,
    default_to,
    email_is_valid,
    map_values,
    null_when,
    object_id,
    truncate_text,
)

__all__ = [
    "clamp_at_zero", "default_to", "document_time", "email_is_valid", "epoch_seconds",
    "frame_body", "frame_magic", "frame_schema_id", "from_micros", "from_millis",
    "map_values", "null_when", "object_id", "row_digest", "truncate_text",
]
