"""Keyed and plain digests, authenticated encryption, keyed uniform numbers."""

from __future__ import annotations

import base64
import os

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark import contract as C

_BLOCK = 64  # SHA-256 block size in bytes


def key_from_env(name: str) -> bytes:
    """32-byte key from an environment variable holding base64 text."""
    text = os.environ.get(name)
    if not text:
        raise KeyError(f"{name} is not set; it must hold base64 of 32 bytes")
    try:
        key = base64.b64decode(text, validate=True)
    except ValueError as bad:
        raise ValueError(f"{name} is not base64") from bad
    if len(key) != 32:
        raise ValueError(f"{name} holds {len(key)} bytes, 32 are needed")
    return key


def bytes_literal(value: bytes) -> Column:
    return F.lit(bytearray(value)).cast("binary")


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of a string, from the built-in SHA-256."""
    if len(key) > _BLOCK:
        raise ValueError("key longer than one hash block")
    padded = key.ljust(_BLOCK, b"\0")
    inner = bytes_literal(bytes(b ^ 0x36 for b in padded))
    outer = bytes_literal(bytes(b ^ 0x5C for b in padded))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def encrypt(key: bytes, plaintext: Column, iv: Column | None = None) -> Column:
    """AES-256-GCM as IV(12) | ciphertext | tag(16). Without ``iv`` it is random."""
    args = [F.encode(plaintext, "UTF-8"), bytes_literal(key), F.lit("GCM"), F.lit("DEFAULT")]
    return F.aes_encrypt(*args, iv) if iv is not None else F.aes_encrypt(*args)


def decrypt(key: bytes, blob: Column) -> Column:
    """Plaintext, or NULL when the blob is damaged or the key is wrong."""
    return F.try_aes_decrypt(blob, bytes_literal(key), F.lit("GCM"), F.lit("DEFAULT")).cast("string")


def uniform(seed: int, stream: str, *keys: Column) -> Column:
    """Number in [0, 1) that depends on seed, stream name and keys only."""
    bits = F.xxhash64(F.lit(seed), F.lit(stream), *keys)
    return F.pmod(bits, F.lit(1 << 53)) / F.lit(float(1 << 53))


def uniform_int(seed: int, stream: str, low: Column | int, high: Column | int, *keys: Column) -> Column:
    """Whole number in [low, high]."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return (low + F.pmod(F.xxhash64(F.lit(seed), F.lit(stream), *keys), high - low + 1)).cast("bigint")


def pick(seed: int, stream: str, pool: tuple[str, ...], *keys: Column) -> Column:
    index = uniform_int(seed, stream, 1, len(pool), *keys).cast("int")
    return F.element_at(F.array(*[F.lit(p) for p in pool]), index)


def deterministic_iv(seed: int, stream: str, *keys: Column) -> Column:
    """12 bytes from the keys: reproducible test data only, never for real secrets."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), F.lit(stream), *[k.cast("string") for k in keys])
    return F.unhex(F.substring(F.sha2(text, 256), 1, 2 * C.IV_BYTES))


def uuid_text(seed: int, stream: str, *keys: Column) -> Column:
    """Version-4 shaped UUID text derived from the keys."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), F.lit(stream), *[k.cast("string") for k in keys])
    h = F.sha2(text, 256)
    part = lambda start, size: F.substring(h, start, size)
    return F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("4"), part(14, 3)),
        F.concat(F.lit("a"), part(18, 3)),
        part(21, 12),
    )
