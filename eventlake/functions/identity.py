"""Deterministic identifiers built from hash expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 4122 namespace for URLs.
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"

_VARIANT_NIBBLES = "89ab"


def uuid5_url(name: Column) -> Column:
    """Version-5 UUID of ``name`` in the URL namespace, as ``uuid.uuid5`` would give it."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    # RFC 4122: the 13th hex digit is the version, the top two bits of the 17th are '10'.
    low_bits = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4
    variant = F.substring(F.lit(_VARIANT_NIBBLES), low_bits + F.lit(1), F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def natural_key(*parts: Column) -> Column:
    """SHA-256 over the parts as text joined by ``||``; NULL counts as the empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws("||", *texts), 256)
