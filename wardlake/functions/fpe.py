"""Format-preserving encryption after NIST SP 800-38G (FF1) as column functions.

Values go to Python in Arrow batches. The values of a batch with the same number of
symbols are encrypted together, ten cipher calls for all of them (``ff1``); the
length of a value is not bounded.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from wardlake.functions.ff1 import Aes, ff1, to_numbers, to_symbols

DIGITS = "0123456789"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"numeric": DIGITS, "alphabetic": LETTERS, "alphanumeric": DIGITS + LETTERS}


@dataclass(frozen=True)
class KeyVersion:
    """Key and tweak material (hex) of one version."""

    key_hex: str
    tweak_hex: str = ""
    sequence: int = 1
    active: bool = True


def pick_version(versions: list[KeyVersion], sequence: int | None, encrypt: bool) -> KeyVersion:
    """The given version, or the latest active one; inactive ones only decrypt."""
    if sequence is None:
        live = [v for v in versions if v.active]
        if not live:
            raise ValueError("no active key version")
        return max(live, key=lambda v: v.sequence)
    for v in versions:
        if v.sequence == sequence:
            if encrypt and not v.active:
                raise ValueError(f"version {sequence} is deactivated and only decrypts")
            return v
    raise ValueError(f"no key version {sequence}")


@dataclass(frozen=True)
class _Alphabet:
    """The symbols of values, and how short a value may be."""

    symbols: str

    @classmethod
    def of(cls, name: str) -> _Alphabet:
        symbols = ALPHABETS.get(name, name)
        if len(set(symbols)) != len(symbols) or len(symbols) < 2:
            raise ValueError("an alphabet needs two or more different symbols")
        return cls(symbols)

    @property
    def shortest(self) -> int:
        """SP 800-38G asks for at least a million different inputs of the same length."""
        return max(2, math.ceil(6 / math.log10(len(self.symbols)) - 1e-9))

    @property
    def mark(self) -> int:
        """Padded values begin with the number of padding symbols, in so many symbols."""
        mark = 1
        while len(self.symbols) ** mark <= self.shortest:
            mark += 1
        return mark


def _padding(missing: int, alphabet: _Alphabet) -> list[int]:
    """The number of missing symbols, and as many of the first symbol."""
    return to_symbols([missing], len(alphabet.symbols), alphabet.mark)[0].tolist() + [0] * missing


def _run(values: pd.Series, alphabet: _Alphabet, version: KeyVersion, is_padded: bool, decrypt: bool) -> pd.Series:
    cipher, tweak = Aes(bytes.fromhex(version.key_hex)), bytes.fromhex(version.tweak_hex)
    number = {c: i for i, c in enumerate(alphabet.symbols)}
    groups: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for row, value in enumerate(values):
        body = [] if value is None else [number[c] for c in value if c in number]
        if not body:
            continue
        if is_padded and not decrypt:
            body = _padding(max(alphabet.shortest - len(body), 0), alphabet) + body
        elif len(body) < alphabet.shortest:
            raise ValueError(f"value needs {alphabet.shortest} or more symbols of the alphabet, has {len(body)}")
        groups[len(body)].append((row, body))
    out = values.tolist()
    for rows in groups.values():
        done = ff1(np.array([body for _, body in rows], np.int64), len(alphabet.symbols), cipher, tweak, decrypt).tolist()
        for (row, _), codes in zip(rows, done):
            spare, source = 0, out[row]
            front = ""
            if is_padded and decrypt:
                # symbols that padding added stand in front, before any other character
                spare = to_numbers(np.array([codes[:alphabet.mark]]), len(alphabet.symbols))[0] + alphabet.mark
                source = source[spare:]
            elif is_padded:
                spare = len(codes) - sum(c in number for c in source)
                front = "".join(alphabet.symbols[k] for k in codes[:spare])
            new = iter(codes[spare:])
            out[row] = front + "".join(alphabet.symbols[next(new)] if c in number else c for c in source)
    return pd.Series(out, dtype=object)


def _transform(col: Column, alphabet: str, version: KeyVersion, is_padded: bool, decrypt: bool) -> Column:
    known = _Alphabet.of(alphabet)

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return _run(values, known, version, is_padded, decrypt)

    return run(col)


def fpe_encrypt(col: Column, alphabet: str, versions: list[KeyVersion],
                sequence: int | None = None, is_padded: bool = False) -> Column:
    """Encrypt the symbols of the alphabet; other characters stay in place.

    A value without symbols of the alphabet is returned as it is. A shorter value
    than FF1 allows raises, unless ``is_padded``: then every value is encrypted
    together with the number of padding symbols before it, so that decryption gives
    back its length; the result is longer by these symbols. A value may be as long
    as a string.
    """
    return _transform(col, alphabet, pick_version(versions, sequence, encrypt=True), is_padded, decrypt=False)


def fpe_decrypt(col: Column, alphabet: str, versions: list[KeyVersion],
                sequence: int | None = None, is_padded: bool = False) -> Column:
    """Reverse ``fpe_encrypt``, given the same ``is_padded``."""
    return _transform(col, alphabet, pick_version(versions, sequence, encrypt=False), is_padded, decrypt=True)


def latest_version(keys: DataFrame) -> DataFrame:
    """Latest active ``sequence`` per (namespace, name) of a key registry."""
    return (
        keys.filter(F.lower("status") == "active")
        .groupBy("namespace", "name")
        .agg(F.max(F.col("sequence").cast(T.IntegerType())).alias("sequence"))
    )
