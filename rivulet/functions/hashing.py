"""Polynomial string hash used for bitmap unique-visitor offsets (H1).

``h = fold(chars, 0, (h, c) -> h * seed + code(c))`` masked to ``bits`` bits.
Each step is reduced modulo 2^bits: the result equals the 64-bit wrapping form
followed by the mask (2^bits divides 2^64), and ANSI mode never overflows.
It is a built-in higher-order expression, evaluated in the JVM. Characters
are taken by code point, which equals Java's UTF-16 ``charAt`` for every
character in the Basic Multilingual Plane (ids are digits in the reference);
a supplementary character (e.g. an emoji) would hash differently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: hash parameters that must equal the reference's --------
DEFAULT_SEED = 61
DEFAULT_BITS = 29  # bitmap of 2^29 bits
# ---------------------------------------------------------------------------


def poly_hash(c, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> Column:
    """Offset of a string in a 2^bits bitmap. NULL input gives NULL."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    modulus = F.lit(1 << bits).cast("long")
    codes = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.ascii(F.substring(s, i, 1)).cast("long"))
    # empty string: sequence(1, 0) counts down, so guard it
    folded = F.aggregate(codes, F.lit(0).cast("long"), lambda acc, ch: (acc * seed + ch) % modulus)
    return F.when(F.length(s) == 0, F.lit(0).cast("long")).otherwise(folded)


def poly_hash_sql(expr: str, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> str:
    """The same hash as a DuckDB SQL expression (for oracles)."""
    m = 1 << bits
    return (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST({expr} AS VARCHAR), ''), "
        f"lambda x: ascii(x)::BIGINT)), lambda a, b: (a * {seed} + b) % {m})"
    )
