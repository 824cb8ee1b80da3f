"""Text formats that outputs must reproduce: ISO instants, trending lines,
Python-style number text, base64 and the key-value REST payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwheel.schema import KV_FAMILY, TRENDING_LINE_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_instant_text(ts: Column | str) -> Column:
    """Timestamp -> ``2026-07-01T10:00:30Z`` (UTC; ``.SSS`` only when the
    milliseconds are not zero), the text form of ``java.time.Instant``."""
    utc = F.to_utc_timestamp(_col(ts), F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    with_ms = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.when(F.unix_millis(_col(ts)) % 1000 == 0, whole).otherwise(with_ms)


def trending_line(start: Column | str, end: Column | str, product: Column | str, n: Column | str) -> Column:
    """``janela=[<start> -> <end>] produto=<p> eventos=<n>``."""
    return F.format_string(
        TRENDING_LINE_FORMAT,
        iso_instant_text(start),
        iso_instant_text(end),
        _col(product),
        _col(n),
    )


def python_text(x: Column | str) -> Column:
    """Double column -> the text Python's ``str()`` gives for it.

    Strings and integers are unchanged by a cast.  Doubles differ: Spark
    prints 1.5E7 where Python prints 15000000.0, and Spark prints 1.0E-4 where
    Python prints 0.0001.  Python uses exponent form only below 1e-4 or from
    1e16 on, with at least two exponent digits (``1e+16``, ``1e-05``).
    """
    c = _col(x)
    s = c.cast("string")
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.regexp_replace(s, "^-", "")
    mant = F.regexp_extract(body, r"^([0-9.]+)E(-?[0-9]+)$", 1)
    exp = F.regexp_extract(body, r"^([0-9.]+)E(-?[0-9]+)$", 2).cast("int")
    digits = F.regexp_replace(mant, r"\.", "")
    # digits d0 d1 d2 ... with value d0.d1d2... x 10^exp
    int_len = exp + F.lit(1)
    plain_big = F.concat(
        F.rpad(digits, F.greatest(int_len, F.length(digits)), "0").substr(F.lit(1), int_len),
        F.lit("."),
        F.coalesce(F.nullif(digits.substr(int_len + 1, F.lit(400)), F.lit("")), F.lit("0")),
    )
    plain_small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), F.regexp_replace(digits, "0+$", ""))
    mant_short = F.regexp_replace(mant, r"\.0$", "")
    sci = F.concat(
        mant_short,
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exp) < 10, F.concat(F.lit("0"), F.abs(exp).cast("string"))).otherwise(
            F.abs(exp).cast("string")
        ),
    )
    has_exp = body.rlike(r"^[0-9.]+E-?[0-9]+$")
    formatted = (
        F.when(~has_exp, body)
        .when((exp >= 0) & (exp < 16), plain_big)
        .when((exp < 0) & (exp >= -4), plain_small)
        .otherwise(sci)
    )
    special = (
        F.when(s == "NaN", F.lit("nan"))
        .when(s == "Infinity", F.lit("inf"))
        .when(s == "-Infinity", F.lit("-inf"))
    )
    return F.coalesce(special, F.concat(sign, formatted))


def b64_utf8(x: Column | str) -> Column:
    """Text -> UTF-8 bytes -> base64 text."""
    return F.base64(F.encode(_col(x), "UTF-8"))


def kv_payload(row_key: Column | str, cells: Column | str) -> Column:
    """JSON body of one key-value row put::

        {"Row":[{"key":b64(key),"Cell":[{"column":b64("cf:name"),"$":b64(value)},...]}]}

    ``cells`` is an array of struct(column string, value string) where column
    is the qualifier without the family.
    """
    encoded = F.transform(
        _col(cells),
        lambda c: F.struct(
            b64_utf8(F.concat(F.lit(KV_FAMILY + ":"), c["column"])).alias("column"),
            b64_utf8(c["value"]).alias("$"),
        ),
    )
    row = F.struct(b64_utf8(row_key).alias("key"), encoded.alias("Cell"))
    return F.to_json(F.struct(F.array(row).alias("Row")))
