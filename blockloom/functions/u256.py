"""Exact 256-bit conversions.

Values of up to 64 bits are converted by column expressions. Longer ones go through Arrow batches to Python's integers, whose
conversions take about a microsecond each, where sums of limbs in array functions took a hundred."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOP, _SIGN = 1 << 256, 1 << 255
_HEX, _DEC = re.compile("[0-9a-fA-F]{1,64}").fullmatch, re.compile("[0-9]+").fullmatch


def _to_dec(word: str | None) -> str | None:
    return str(int(word, 16)) if word is not None and _HEX(word) else None


def _to_signed(word: str | None) -> str | None:
    if word is None or not _HEX(word):
        return None
    v = int(word, 16)
    return str(v - _TOP if v >= _SIGN else v)


def _to_hex(dec: str | None) -> str | None:
    if dec is None or not _DEC(dec):
        return None
    v = int(dec)
    return f"{v:064x}" if v < _TOP else None


def _from_signed(dec: str | None) -> str | None:
    if dec is None or not _DEC(dec.removeprefix("-")):
        return None
    v = int(dec)
    return f"{v % _TOP:064x}" if -_SIGN <= v < _SIGN else None


def _by_value(f):
    @F.arrow_udf(T.StringType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array(list(map(f, values.to_pylist())), pa.string())

    return run


def _by_item(f):
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else list(map(f, x)) for x in lists.to_pylist()], pa.list_(pa.string()))

    return run


_dec_of, _signed_of, _hex_of, _word_of = map(_by_value, (_to_dec, _to_signed, _to_hex, _from_signed))
#: Arrays of words to decimal strings, and back.
u256_decs, u256_hexes = map(_by_item, (_to_dec, _to_hex))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip0x(c: Column) -> Column:
    return F.when(F.substr(c, F.lit(1), F.lit(2)).isin("0x", "0X"), F.substr(c, F.lit(3))).otherwise(c)


def hex_to_binary(c: Column, size: int) -> Column:
    """Hex with or without 0x to at least `size` bytes, padded on the left; null stays null, bad hex raises no error but gives null."""
    h = strip0x(c)
    return F.unhex(F.when(F.length(h) >= 2 * size, h).otherwise(F.lpad(h, 2 * size, "0")))


def u256_dec(word: Column) -> Column:
    """64 hex digits to a decimal string; null if they are none."""
    small = word.startswith("0" * 48)
    return F.when(small, F.conv(F.substr(word, F.lit(49)), 16, 10)).otherwise(_dec_of(F.when(~small, word)))


def u256_hex(dec: Column) -> Column:
    """A decimal string to 64 hex digits; null if it is no number below 2**256."""
    small = F.length(dec) <= 18
    return F.when(small, F.lpad(F.lower(F.hex(dec.try_cast("long"))), 64, "0")).otherwise(_hex_of(F.when(~small, dec)))


def dec_to_b32(dec: Column) -> Column:
    return F.unhex(u256_hex(dec))


def i256_dec(word: Column) -> Column:
    """64 hex digits in two's complement to a signed decimal string."""
    small = word.startswith("0" * 48)
    return F.when(small, F.conv(F.substr(word, F.lit(49)), 16, 10)).otherwise(_signed_of(F.when(~small, word)))


def i256_hex(dec: Column) -> Column:
    """A signed decimal string to 64 hex digits in two's complement; null if it is none or needs more than 256 bits."""
    small = (F.length(dec) <= 18) & ~dec.startswith("-")
    return F.when(small, F.lpad(F.lower(F.hex(dec.try_cast("long"))), 64, "0")).otherwise(_word_of(F.when(~small, dec)))


def to_u32(c: Column, strict: bool = False) -> Column:
    """An integer masked to 32 bits; strict raises when that would change it."""
    n = c.cast("long")
    masked = F.pmod(n, F.lit(1 << 32))
    return F.when(masked.eqNullSafe(n), masked).otherwise(F.raise_error(F.lit("not an unsigned 32-bit integer"))) if strict else masked


def parse_hex(c: Column) -> Column:
    """A hex quantity to a bigint; null, empty and 0x are 0."""
    return F.coalesce(F.conv(F.nullif(strip0x(c), F.lit("")), 16, 10).cast("long"), F.lit(0).cast("long"))


def topic_address(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.right(c, F.lit(40))))


def u256_array_json(words: Column) -> Column:
    """An array of 64-digit words to a JSON array of decimal strings."""
    return F.to_json(u256_decs(words))
