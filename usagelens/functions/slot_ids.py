"""Name-based UUIDs (version 5) for time slots, from built-in functions only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace and the name pattern that make one slot always get one id.
SLOT_NAMESPACE = uuid.UUID("a1b2c3d4-e5f6-7890-abcd-ef1234567890")
SLOT_NAME_PATTERN = "yyyy-MM-dd HH:mm"


def uuid5(name: Column, namespace: uuid.UUID = SLOT_NAMESPACE) -> Column:
    """RFC 9562 version 5 UUID of a string column."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    # The variant nibble keeps its two low bits and gets binary 10 in front.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def slot_event_id(slot: Column | str) -> Column:
    """Event id of a minute slot; the same minute always gives the same id."""
    slot = F.col(slot) if isinstance(slot, str) else slot
    return uuid5(F.date_format(slot, SLOT_NAME_PATTERN))
