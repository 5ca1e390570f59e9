"""Numeric helpers shared by the feature and scoring operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Computed doubles are published at 6 decimals so two engines agree exactly.
PUBLISH_SCALE = 6


def r6(c: Column) -> Column:
    return F.round(c, PUBLISH_SCALE)


def hash_uniform(*parts: Column, seed: int = 0) -> Column:
    """Reproducible uniform [0, 1) from the md5 of ``seed:part:part...``.

    Uses the first 32 bits of the digest; the same text hashes identically in
    any engine with md5, unlike a generator's stream.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return bits / F.lit(4294967296.0)


def python_float_text(v: Column) -> Column:
    """A double as Python's ``str(float)`` prints it, from built-in functions.

    Java (Spark's cast) switches to ``1.0E7`` / ``5.0E-4`` notation outside
    [1e-3, 1e7); Python prints plain digits in [1e-4, 1e16) and ``1e-05`` /
    ``1e+16`` outside. Inside Java's plain range both print the same text.
    """
    java = v.cast("string")
    exp = F.regexp_extract(java, r"E(-?[0-9]+)$", 1)
    e = F.when(exp != "", exp.cast("int"))
    # plain digits: the decimal expansion of the same shortest digits
    plain = F.regexp_replace(F.regexp_replace(v.cast("decimal(38,20)").cast("string"),
                                              r"0+$", ""), r"\.$", ".0")
    mant = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    sci = F.concat(mant, F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.lpad(F.abs(e).cast("string"), 2, "0"))
    return (F.when(F.abs(v) == float("inf"), F.when(v < 0, "-inf").otherwise("inf"))
            .when(F.isnan(v), "nan")
            .when(e.isNull(), java)
            .when((e >= -4) & (e < 16), plain)
            .otherwise(sci))
