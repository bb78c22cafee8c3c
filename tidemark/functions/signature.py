"""Keyed message signatures as native expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _col

BLOCK = 64


def _pads(key: str) -> tuple[bytes, bytes]:
    raw = key.encode("utf-8")
    if len(raw) > BLOCK:
        raise ValueError("keys longer than one hash block are not supported")
    raw = raw.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in raw), bytes(b ^ 0x5C for b in raw)


def hmac_hex(message, key: str, algorithm: str = "sha256") -> Column:
    """Hex HMAC of a text column with one secret key."""
    digest = {"sha256": lambda x: F.sha2(x, 256), "sha1": F.sha1}[algorithm]
    inner_pad, outer_pad = (F.lit(bytearray(p)) for p in _pads(key))
    inner = digest(F.concat(inner_pad, F.encode(_col(message), "utf-8")))
    return digest(F.concat(outer_pad, F.unhex(inner)))


def chat_signature(timestamp, body, key: str) -> Column:
    """Signature of a chat webhook: version, time and the stripped body."""
    text = F.concat_ws(":", F.lit("v0"), _col(timestamp), F.trim(_col(body)))
    return F.concat(F.lit("v0="), hmac_hex(text, key, "sha256"))


def repository_signature(body, key: str) -> Column:
    """Signature of a repository webhook."""
    return F.concat(F.lit("sha1="), hmac_hex(body, key, "sha1"))


def matches(received, calculated) -> Column:
    """True only for a present and equal signature."""
    return F.coalesce(_col(received) == calculated, F.lit(False))
