"""Request headers and client addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_H = r"[0-9A-Fa-f]{1,4}"


def _ipv6() -> str:
    """Eight groups, or fewer around one ``::``; the last two may be written as IPv4."""
    forms = [rf"(?:{_H}:){{7}}{_H}", rf"(?:{_H}:){{6}}{IPV4}"]
    for before in range(8):
        head = rf"{_H}(?::{_H}){{{before - 1}}}::" if before else "::"
        after = 7 - before  # the gap stands for one zero group at least
        tails = [rf"(?:{_H}(?::{_H}){{0,{after - 1}}})?"] if after else [""]
        if after >= 2:
            tails.append(rf"(?:{_H}:){{0,{after - 2}}}{IPV4}")
        forms += [head + tail for tail in tails]
    return "|".join(forms)


IP_ADDRESS = rf"\A(?:{IPV4}|{_ipv6()})\z"


def is_ip(text: Column) -> Column:
    return F.rlike(text, F.lit(IP_ADDRESS))


def normalize_headers(headers: Column) -> Column:
    """Lower-case names, the last duplicate wins, values that are no text are dropped.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (see weirflow.configure).
    A value is text when it holds visible ASCII, spaces and tabs only.
    """
    text_only = F.map_filter(
        headers, lambda _, v: v.isNotNull() & F.rlike(v, F.lit(r"\A[\x20-\x7E\t]*\z"))
    )
    return F.transform_keys(text_only, lambda k, _: F.lower(k))


def header(headers: Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name.lower()))


def client_ip(headers: Column, strict: bool = False) -> Column:
    """First forwarded address, else the real-ip header, else NULL.

    ``strict`` wants a well-formed address and falls through to the next source
    otherwise; it is what per-address limits use.
    """
    forwarded = F.trim(
        F.split_part(header(headers, "x-forwarded-for"), F.lit(","), F.lit(1)), F.lit(" \t")
    )
    real = header(headers, "x-real-ip")
    if strict:
        forwarded = F.when(is_ip(forwarded), forwarded)
        real = F.when(is_ip(real), real)
    return F.coalesce(forwarded, real)


def canonical_ip(ip: Column) -> Column:
    """One spelling for each address: IPv6 in lower case, in eight groups without leading zeros."""
    text = F.lower(ip)
    # An IPv4 tail stands for the last two groups.
    tail = F.split(F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+){3})$", 1), r"\.")
    pair = lambda i: F.conv((F.get(tail, F.lit(i)).cast("int") * 256 + F.get(tail, F.lit(i + 1)).cast("int")).cast("string"), 10, 16)
    hexed = F.when(
        text.contains("."),
        F.concat(F.regexp_replace(text, r"[0-9]+(?:\.[0-9]+){3}$", ""), F.lower(pair(0)), F.lit(":"), F.lower(pair(2))),
    ).otherwise(text)
    groups = lambda part: F.filter(F.split(part, ":"), lambda x: x != "")
    left, right = groups(F.split_part(hexed, F.lit("::"), F.lit(1))), groups(F.split_part(hexed, F.lit("::"), F.lit(2)))
    missing = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    every = F.transform(F.concat(left, missing, right), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
    return F.when(text.contains(":"), F.array_join(every, ":")).otherwise(text)
