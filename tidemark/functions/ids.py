"""Deterministic identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Our own name spaces; ids need be stable, not equal to anyone else's.
NS_HOT = uuid.uuid5(uuid.NAMESPACE_DNS, "hot.tidemark")
NS_RAW = uuid.uuid5(uuid.NAMESPACE_DNS, "raw.tidemark")
NS_CLEAN = uuid.uuid5(uuid.NAMESPACE_DNS, "clean.tidemark")
NS_TASK = uuid.uuid5(uuid.NAMESPACE_DNS, "task.tidemark")
NS_EVENT = uuid.uuid5(uuid.NAMESPACE_DNS, "event.tidemark")


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 4122 name-based UUID, inside the JVM."""
    h = F.sha1(F.concat(F.lit(bytearray(namespace.bytes)), F.encode(name, "UTF-8")))
    variant = F.substr(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
