"""Name-based (version 5) UUIDs from built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 9562.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace_hex: str = DNS_NAMESPACE) -> Column:
    """UUIDv5 text of ``name``: SHA-1 of namespace bytes and UTF-8 name, with the
    version digit forced to 5 and the top two bits of the variant digit to 10."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def song_key(artist: Column, song: Column) -> Column:
    """Stable song id: UUIDv5 of ``artist::song``."""
    return uuid5(F.concat(artist, F.lit("::"), song))
