"""Row hash keys (content-addressed keys for idempotent loads)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import fixed

HASH_ALGOS = ("sha256", "sha512", "sha3_512")
KEY_MODES = ("exact", "compat")
_NULL_PART = "-"


def key_text(cols: list[Column], mode: str = "exact", sep: str = fixed.KEY_SEPARATOR,
             null_token: str | None = None, is_text: list[bool] | None = None) -> Column:
    """Text that is hashed.

    ``exact`` writes every part with its length before it and NULL as a mark of
    its own, so different rows never give the same text. ``compat`` is the bare
    join by ``sep`` that targets keyed elsewhere hold: NULL cells are skipped
    (``(NULL, a)`` and ``(a, NULL)`` give the same text) unless ``null_token``
    stands for them, and a part that contains ``sep`` reads like two. ``is_text``
    marks columns already of string type (no cast needed).
    """
    flags = is_text or [False] * len(cols)
    parts = [c if text else c.cast("string") for c, text in zip(cols, flags)]
    if mode == "exact":
        if null_token is not None:
            raise ValueError("null_token belongs to key mode 'compat': exact keys mark NULL themselves")
        sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
        return F.concat(*[F.coalesce(p, F.lit(_NULL_PART)) for p in sized])
    if mode != "compat":
        raise ValueError(f"unknown key mode {mode!r}; expected one of {KEY_MODES}")
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.concat_ws(sep, *parts)


def sha3_512_hex(text: Column) -> Column:
    """SHA3-512 as lower-case hex, computed in the JVM (no Python worker).

    Spark has no SHA-3 function; commons-codec ships with Spark. Catalyst
    treats ``try_reflect`` as non-deterministic, so add this key after any
    row filter.
    """
    return F.try_reflect(
        F.lit("org.apache.commons.codec.digest.DigestUtils"), F.lit("sha3_512Hex"), text
    )


def hash_text(text: Column, algo: str = "sha256") -> Column:
    if algo == "sha256":
        return F.sha2(text, 256)
    if algo == "sha512":
        return F.sha2(text, 512)
    if algo == "sha3_512":
        return sha3_512_hex(text)
    raise ValueError(f"unknown hash algorithm {algo!r}; expected one of {HASH_ALGOS}")


def hash_key(cols: list[Column], algo: str | None = None, mode: str = "exact", sep: str = fixed.KEY_SEPARATOR,
             null_token: str | None = None, is_text: list[bool] | None = None) -> Column:
    """Hex digest of the key text; by default SHA-256, or SHA3-512 in ``compat`` mode."""
    algo = algo or ("sha3_512" if mode == "compat" else "sha256")
    return hash_text(key_text(cols, mode, sep, null_token, is_text), algo)
