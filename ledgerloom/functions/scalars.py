"""String, numeric, conditional, JSON and hash functions as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

__all__ = [
    "amount_sum",
    "array_at",
    "cents",
    "exact_amount",
    "minor_units",
    "fits_bytes",
    "fixed_text",
    "hex_to_base64",
    "json_array",
    "json_scalar",
    "key_hash",
    "mask_alnum",
    "null_if_empty",
    "null_if_sentinel",
    "parse_numeric",
    "range_bucket",
    "regexp_first",
    "round_to_long",
    "sha256_hex",
    "split_at",
    "split_text",
    "stable_bucket",
    "strict_greatest",
    "strict_least",
    "strip",
    "text_number",
    "truncate_to",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: Column | str) -> Column:
    """Whole cents of a *double* that holds an amount with two decimals, up to 2^53 cents; cheap to build.

    Not for decimals, nor for amounts with more decimals: use ``exact_amount`` there.
    """
    return F.rint(_col(c) * 100).cast("long")


def amount_sum(c: Column | str) -> Column:
    """Sum of doubles that hold amounts with two decimals, exact until its last conversion to a double."""
    return F.sum(cents(c).cast("decimal(18,0)")).cast("double") / 100


def exact_amount(df: DataFrame, name: str, scale: int = 6) -> Column:
    """The column as a decimal that can be summed without rounding: decimals as they are, others with ``scale`` digits."""
    kind = df.schema[name].dataType
    return F.col(name) if isinstance(kind, DecimalType) else F.col(name).cast(f"decimal(28,{scale})")


def minor_units(df: DataFrame, name: str) -> Column:
    """Whole cents of an amount with two decimals: exact for decimals, by ``cents`` for doubles."""
    kind = df.schema[name].dataType
    if isinstance(kind, DecimalType):
        return F.round(F.col(name) * 100, 0).cast("decimal(38,0)")
    return cents(name)


def strip(c: Column | str) -> Column:
    """TRIM of every kind of white space (Spark's ``trim`` removes blanks only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def null_if_sentinel(c: Column | str, sentinel: int = -999, precision: str = "decimal(38,9)") -> Column:
    """Numeric value of a text column, NULL when unparsable or equal to the sentinel."""
    return F.nullif(_col(c).try_cast(precision), F.lit(sentinel).cast(precision))


def strict_greatest(*columns: Column | str) -> Column:
    """GREATEST that is NULL when any argument is NULL."""
    cols = [_col(c) for c in columns]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.greatest(*cols))


def strict_least(*columns: Column | str) -> Column:
    """LEAST that is NULL when any argument is NULL."""
    cols = [_col(c) for c in columns]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.least(*cols))


def round_to_long(c: Column | str) -> Column:
    """CAST of a fraction to an integer: half away from zero (Spark's cast truncates)."""
    return F.round(_col(c)).cast("long")


def truncate_to(c: Column | str, digits: int = 0) -> Column:
    """TRUNC: cut toward zero after ``digits`` decimals."""
    scaled = _col(c) * F.lit(10.0**digits)
    return F.when(scaled >= 0, F.floor(scaled)).otherwise(F.ceil(scaled)) / F.lit(10.0**digits)


def parse_numeric(c: Column | str) -> Column:
    """SAFE.PARSE_NUMERIC: decimal(38,9) or NULL."""
    return strip(c).try_cast("decimal(38,9)")


def text_number(c: Column | str, digits: int = 2) -> Column:
    """FORMAT('%.nf'): fixed number of decimals as text."""
    return F.format_string(f"%.{digits}f", _col(c).cast("double"))


def regexp_first(c: Column | str, pattern: str, group: int = 1) -> Column:
    """REGEXP_EXTRACT that is NULL without a match (Spark gives '')."""
    return F.when(_col(c).rlike(pattern), F.regexp_extract(_col(c), pattern, group))


def split_text(c: Column | str, delimiter: str) -> Column:
    """SPLIT on a literal delimiter (Spark's pattern is a regular expression)."""
    return F.split(_col(c), "\\Q" + delimiter + "\\E", -1)


def split_at(c: Column | str, delimiter: str, index: int) -> Column:
    """Field ``index`` (from 0) of a delimited text, NULL when absent or empty."""
    return null_if_empty(F.get(split_text(c, delimiter), F.lit(index)))


def array_at(arr: Column | str, index: int) -> Column:
    """SAFE_OFFSET: NULL out of range."""
    return F.get(_col(arr), F.lit(index))


def mask_alnum(c: Column | str, mark: str = "X") -> Column:
    return F.regexp_replace(_col(c), "[a-zA-Z0-9]", mark)


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(_col(c).cast("string"), 256)


def hex_to_base64(c: Column | str) -> Column:
    return F.base64(F.unhex(_col(c)))


def key_hash(columns: Sequence[Column | str], separator: str | None = None) -> Column:
    """Base64 of the MD5 of the joined keys; NULL when any key is NULL.

    Without a separator ('1','23') and ('12','3') collide, which is how existing hashes were made; give
    a separator for new tables.
    """
    parts = [_col(c).cast("string") for c in columns]
    if separator is not None:
        parts = [p for c in parts for p in (F.lit(separator), c)][1:]
    return F.base64(F.unhex(F.md5(F.concat(*parts))))


def stable_bucket(c: Column | str, buckets: int = 10000) -> Column:
    """Repeatable bucket 0..buckets-1 of an identifier, from its MD5, so that any engine can restate it."""
    prefix = F.substring(F.md5(_col(c).cast("string")), 1, 15)
    return F.pmod(F.conv(prefix, 16, 10).cast("long"), F.lit(buckets))


def range_bucket(c: Column | str, edges: Sequence[float]) -> Column:
    """RANGE_BUCKET: how many of the ascending ``edges`` are <= the value; NULL for NULL."""
    x = _col(c)
    steps = [F.when(x >= F.lit(e), 1).otherwise(0) for e in edges]
    return F.when(x.isNotNull(), reduce(lambda a, b: a + b, steps))


def json_scalar(c: Column | str, path: str) -> Column:
    """JSON_VALUE: the scalar at ``path``, NULL when it is an object or an array."""
    value = F.get_json_object(_col(c), path)
    return F.when(~value.rlike(r"^\s*[\[{]"), value)


def json_array(c: Column | str, path: str, element: str = "string") -> Column:
    """JSON_EXTRACT_ARRAY: the array at ``path``."""
    return F.from_json(F.get_json_object(_col(c), path), f"array<{element}>")


def fits_bytes(c: Column | str, limit: int) -> Column:
    """Longest prefix of whole characters within ``limit`` UTF-8 bytes."""
    raw = F.encode(_col(c), "UTF-8")
    # a cut inside a character leaves 1..3 stray bytes at the end: take the longest valid prefix
    prefixes = [F.substring(raw, 1, max(limit - k, 0)).cast("string") for k in range(4)]
    # text that is broken elsewhere gets replacement characters
    repaired = F.make_valid_utf8(prefixes[0])
    return F.when(F.octet_length(raw) <= limit, _col(c)).otherwise(
        F.coalesce(*[F.try_validate_utf8(p) for p in prefixes], repaired)
    )


def fixed_text(c: Column | str, length: int, pad: str = " ", side: str = "right", kind: str = "string") -> Column:
    """One field of a fixed-width record.

    ``side`` names where the padding goes. A negative decimal keeps its sign in the first position.
    Longer values are cut at the end.
    """
    if "decimal" in kind and not (pad == " " or pad.isdigit()):
        raise ValueError(f"decimal fields take digits or blanks as padding, not {pad!r}")
    put = F.lpad if side == "left" else F.rpad
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    plain = put(text, length, pad)
    if "decimal" not in kind:
        return plain
    number = text.try_cast("decimal(38,9)")
    magnitude = F.regexp_replace(text, r"^\s*-", "")
    return F.when(number < 0, F.concat(F.lit("-"), put(magnitude, length - 1, pad))).otherwise(plain)
