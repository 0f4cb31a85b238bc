"""Keyed tokens that stand in for identity numbers: ``<TYPE>_v<key version>_<hex HMAC-SHA256>``.

Two tokenizers with equal results. The native one is a plain expression and stays inside code generation, but
the padded key appears as a literal in the query plan. The Arrow one fetches the key inside the Python worker
and keeps it out of plans and event logs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Tokenizer = Callable[[str | Column, Column], Column]

_BLOCK = 64


def _pads(key: bytes) -> tuple[bytes, bytes]:
    block = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def _prefixed(token_type: str | Column, version: int, hex_digest: Column) -> Column:
    kind = F.lit(token_type) if isinstance(token_type, str) else token_type
    return F.concat(kind, F.lit(f"_v{version}_"), hex_digest)


def pii_token(token_type: str | Column, value: Column, key: bytes, key_version: int = 1) -> Column:
    """HMAC-SHA256 (RFC 2104) written with ``sha2``; NULL stays NULL."""
    inner_pad, outer_pad = _pads(key)
    inner = F.sha2(F.concat(F.lit(inner_pad), F.encode(value, "UTF-8")), 256)
    return _prefixed(token_type, key_version, F.sha2(F.concat(F.lit(outer_pad), F.unhex(inner)), 256))


def native_tokenizer(key: bytes, key_version: int = 1) -> Tokenizer:
    return lambda token_type, value: pii_token(token_type, value, key, key_version)


def arrow_tokenizer(key_provider: Callable[[], bytes], key_version: int = 1) -> Tokenizer:
    """Tokenizer that calls ``key_provider`` in the worker, once per task."""
    @F.pandas_udf(StringType())
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import hashlib as _hashlib
        import hmac as _hmac

        keyed = _hmac.new(key_provider(), digestmod=_hashlib.sha256)

        def one(text):
            if text is None:
                return None
            state = keyed.copy()
            state.update(text.encode("utf-8"))
            return state.hexdigest()

        for values in batches:
            yield values.map(one)

    return lambda token_type, value: _prefixed(token_type, key_version, digest(value))
