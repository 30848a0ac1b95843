"""Checksums, masking and encryption of columns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept by a mask and what follows them.
PARTIAL = (2, "***")
PREFIX = (4, "****")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def checksum_md5(
    columns: Sequence[Column | str], separator: str = "|", null_token: str | None = None
) -> Column:
    """MD5 over the joined text of the columns.

    NULLs are skipped by default, so rows that differ only in where a NULL stands
    share a checksum. ``null_token`` writes the token in their place instead.
    """
    parts = [_col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(separator, *parts))


def change_hash(columns: Sequence[Column | str], key: str = "change") -> Column:
    """Keyed hash that differs whenever any column differs, a NULL and its place included."""
    parts = []
    for c in columns:
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return hmac_sha256(F.concat_ws("|", *parts), key.encode())


def mask_hash(value: Column | str) -> Column:
    """SHA-256 of the text form, in hexadecimal."""
    return F.sha2(_col(value).cast("string"), 256)


class MaskKey(NamedTuple):
    """A secret and the name under which its masks are known."""

    id: str
    secret: bytes


# Block length of SHA-256 and the pads of HMAC.
_BLOCK, _INNER, _OUTER = 64, 0x36, 0x5C


def hmac_sha256(value: Column | str, secret: bytes) -> Column:
    """HMAC-SHA-256 of the text form, in hexadecimal; NULL stays NULL.

    The pads are worked out here and enter the plan as bytes, so whoever may read plans may
    compute masks, as anyone may who runs the job. The secret itself is not in the plan unless
    it is shorter than a block and the reader undoes the pad.
    """
    block = (hashlib.sha256(secret).digest() if len(secret) > _BLOCK else secret).ljust(_BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (_INNER, _OUTER))
    text = F.encode(_col(value).cast("string"), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def mask_hmac(value: Column | str, key: MaskKey) -> Column:
    """Keyed mask ``id:hash``: equal values share it, and without the secret it cannot be found by trial.

    A new key gives new masks; the id says which key a stored one was made with.
    """
    return F.concat(F.lit(f"{key.id}:"), hmac_sha256(value, key.secret))


def mask_matches(value: Column | str, masked: Column | str, keys: Sequence[MaskKey]) -> Column:
    """Whether a mask is that of the value under the key it names; NULL for an unknown key."""
    of_key = [F.when(F.startswith(_col(masked), F.lit(f"{k.id}:")), mask_hmac(value, k) == _col(masked)) for k in keys]
    return F.coalesce(*of_key)


def mask_prefix(value: Column | str, keep: int, filler: str) -> Column:
    """First ``keep`` characters followed by a fixed filler; NULL stays NULL."""
    return F.concat(F.substring(_col(value), 1, keep), F.lit(filler))


def mask_partial(value: Column | str) -> Column:
    return mask_prefix(value, *PARTIAL)


def mask_prefix4(value: Column | str) -> Column:
    return mask_prefix(value, *PREFIX)


def encrypt(value: Column | str, key: Column) -> Column:
    """AES-GCM cipher text in base64. ``key`` holds 16, 24 or 32 bytes."""
    return F.base64(F.aes_encrypt(_col(value).cast("string"), key, F.lit("GCM")))


def decrypt(value: Column | str, key: Column) -> Column:
    """Inverse of :func:`encrypt`, as text."""
    return F.aes_decrypt(F.unbase64(_col(value)), key, F.lit("GCM")).cast("string")
