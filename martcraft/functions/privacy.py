"""Personal-data helpers."""

from __future__ import annotations

import json
from json.decoder import WHITESPACE, scanstring

import pandas as pd
import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def digits_only(col) -> Column:
    """keep 0-9 only."""
    return F.regexp_replace(_c(col).cast("string"), r"[^0-9]", "")


def hmac_sha256_hex(col, secret: bytes | str) -> Column:
    """Keyed hash (HMAC-SHA256, hex) computed with native sha2/unhex.

    The key pads are derived on the driver; the column is hashed on the
    executors.  The secret is mandatory and must be supplied at run time.
    Plans containing it should not be logged.
    """
    if not secret:
        raise ValueError("hmac secret is required")
    key = secret.encode() if isinstance(secret, str) else bytes(secret)
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    ipad = bytes(b ^ 0x36 for b in key)
    opad = bytes(b ^ 0x5C for b in key)
    msg = _c(col).cast("string").cast("binary")
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), msg), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def phone_hash(buyer_cell, buyer_phone, recv_cell, recv_phone, secret) -> Column:
    """digits of the first non-empty phone among the four, keyed-hashed.
    NULL when none has a digit."""
    d = F.coalesce(*[F.nullif(digits_only(c), F.lit("")) for c in
                     (buyer_cell, buyer_phone, recv_cell, recv_phone)])
    return F.when(d.isNotNull(), hmac_sha256_hex(d, secret))


# Personal-data keys removed from a landed order before storage.
PERSONAL_KEYS = ["buyer", "receivers"]


def _without_keys(text: str | None, keys: frozenset[str]) -> str | None:
    """One JSON object's text with the members named in ``keys`` cut out; every other character stays.

    No object, or no JSON: None."""
    if text is None:
        return None
    try:
        at = WHITESPACE.match(text, 0).end()
        if text[at:at + 1] != "{":
            return None
        out, since, cut, first = [], 0, False, True
        at = WHITESPACE.match(text, at + 1).end()
        if text[at] == "}":
            return text if not text[at + 1:].strip() else None
        while True:
            start = at                                       # the member's first character, a quote
            if text[at] != '"':
                return None
            name, at = scanstring(text, at + 1)
            at = WHITESPACE.match(text, at).end()
            if text[at] != ":":
                return None
            _, at = _DECODER.raw_decode(text, WHITESPACE.match(text, at + 1).end())
            end = at
            at = WHITESPACE.match(text, at).end()
            last = text[at] == "}"
            if name in keys:
                # with the comma after it, or before it where it is the last of several
                kept = "".join([*out, text[since:start]])
                if last and not first:
                    kept = kept[:kept.rindex(",")]
                out, cut = [kept], True
                since = end if last else WHITESPACE.match(text, at + 1).end()
            else:
                first = False
            if last:
                if text[at + 1:].strip():
                    return None
                return "".join([*out, text[since:]]) if cut else text
            if text[at] != ",":
                return None
            at = WHITESPACE.match(text, at + 1).end()
    except (ValueError, IndexError):
        return None


_DECODER = json.JSONDecoder()


def strip_personal(col, keys: list[str] = PERSONAL_KEYS) -> Column:
    """drop personal-data keys from the order JSON (re-serialised through
    a variant map, so nested values keep their JSON form; number text may be
    normalised, e.g. 2.50 -> 2.5).  The shapers use this one: it stays inside the JVM."""
    m = F.from_json(_c(col), "map<string,variant>")
    return F.to_json(F.map_filter(m, lambda k, v: ~k.isin(*keys)))


def strip_personal_text(col, keys: list[str] = PERSONAL_KEYS) -> Column:
    """F13 where the text itself must survive: the top-level personal-data members are cut out and every other
    character stays (numbers, spacing, escapes, key order).  What is no JSON object gives NULL.

    Spark's JSON functions write values anew, so the members are found by the JSON scanner of the Python
    library, a batch of texts at a time."""
    named = frozenset(keys)

    @F.pandas_udf("string")
    def strip(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _without_keys(t, named))

    return strip(_c(col))
