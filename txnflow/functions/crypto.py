"""Keyed, irreversible tokens for account and card identifiers.

A token is HMAC-SHA256 in lower-case hex. It is composed from two `sha2` calls,
so no Python worker takes part. The key enters the plan as two binary literals;
`txnflow.session` sets a redaction pattern that hides them in plan texts.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK_BYTES = 64


@dataclass(frozen=True)
class TokenKey:
    """A tokenization secret. The secret never shows in `repr`."""

    secret: bytes = field(repr=False)

    def __post_init__(self):
        if not self.secret:
            raise ValueError("the tokenization secret must not be empty")

    @classmethod
    def from_env(cls, variable: str = "TXNFLOW_TOKEN_SECRET") -> TokenKey:
        value = os.environ.get(variable, "")
        if not value:
            raise OSError(f"set {variable} to the tokenization secret")
        return cls(value.encode("utf-8"))

    def pad(self, byte: int) -> bytes:
        key = self.secret
        if len(key) > _BLOCK_BYTES:
            key = hashlib.sha256(key).digest()
        return bytes(b ^ byte for b in key.ljust(_BLOCK_BYTES, b"\0"))


@dataclass(frozen=True)
class RotatingKey:
    """A key with its id and the first event date it applies to."""

    key_id: str
    key: TokenKey
    valid_from: date


def _token(col: Column | str, key: TokenKey) -> Column:
    text = F.col(col) if isinstance(col, str) else col
    inner = F.sha2(F.concat(F.lit(key.pad(0x36)), text.cast("binary")), 256)
    outer = F.sha2(F.concat(F.lit(key.pad(0x5C)), F.unhex(inner)), 256)
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(outer)


def tokenize_account_id(col: Column | str, key: TokenKey) -> Column:
    """Token of an account id; null and "" both give ""."""
    return _token(col, key)


def tokenize_card_number(col: Column | str, key: TokenKey) -> Column:
    """Token of a card number; null and "" both give ""."""
    return _token(col, key)


def rotating_token(col: Column | str, on_date: Column, keys: Sequence[RotatingKey]) -> Column:
    """`struct(key_id, token)` under the key in force on `on_date`.

    Dates before the first key fall to the first key; without a date the newest
    key is used. The key id stays beside the token, so tokens of different key
    periods are never compared by chance.
    """
    newest_first = sorted(keys, key=lambda k: k.valid_from, reverse=True)
    *newer, oldest = newest_first

    def stamped(k: RotatingKey) -> Column:
        return F.struct(F.lit(k.key_id).alias("key_id"), _token(col, k.key).alias("token"))

    if not newer:
        return stamped(oldest)
    chain = None
    for k in newer:
        branch = on_date >= F.lit(k.valid_from)
        if k is newer[0]:
            branch = branch | on_date.isNull()
        chain = F.when(branch, stamped(k)) if chain is None else chain.when(branch, stamped(k))
    return chain.otherwise(stamped(oldest))
