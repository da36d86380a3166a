"""Hashes and the compact id codec."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 32 digits of the compact id code (no G, L, O, Q).
CODE_DIGITS = "0123456789ABCDEFHIJKMNPRSTUVWXYZ"
CODE_WIDTH = 13
CODE_SUFFIX = "u"

# Digits that Spark's own base-32 conversion uses.
_BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def md5_hex(col: Column) -> Column:
    """Upper-case hex md5."""
    return F.upper(F.md5(col))


def md5_signed64(col: Column) -> Column:
    """First eight digest bytes, little endian, as a signed 64-bit number."""
    # Reversing the hex text turns the byte order but swaps the two digits of
    # each byte, so the digits are swapped back with shifts.
    turned = F.conv(F.reverse(F.substring(F.md5(col), 1, 16)), 16, -10).cast("bigint")
    low_digits = F.lit(0x0F0F0F0F0F0F0F0F)
    return F.shiftleft(turned.bitwiseAND(low_digits), 4).bitwiseOR(
        F.shiftrightunsigned(turned, 4).bitwiseAND(low_digits)
    )


def compact_id_encode(col: Column) -> Column:
    """64-bit id -> 13 base-32 digits plus suffix.

    The value goes through ``hex`` because ``conv`` saturates on the decimal
    text of the smallest 64-bit number.
    """
    digits = F.lpad(F.conv(F.hex(col), 16, 32), CODE_WIDTH, "0")
    return F.concat(F.translate(digits, _BASE32_DIGITS, CODE_DIGITS), F.lit(CODE_SUFFIX))


def compact_id_decode(col: Column) -> Column:
    """Inverse of :func:`compact_id_encode`."""
    digits = F.translate(F.substring(col, 1, CODE_WIDTH), CODE_DIGITS, _BASE32_DIGITS)
    return F.conv(digits, 32, -10).cast("bigint")
