"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, ``://``, plus signs before a digit, digits and the cue
words of identifiers. At each anchor a local parser expands to the span's boundaries and validates it. A parser
never looks further than its own span, and anchors inside a span already read are skipped, so the work is linear
in the text, whatever its length.

Kinds ``email``, ``ip``, ``card`` and ``phone`` follow fixed patterns: leftmost, non-overlapping within a kind,
failing matches dropped. The method adds ``address`` (a web address that names a person: user information, or a
path like ``/~name`` or ``/users/name``) and ``account`` (the value after a cue such as ``password=``, ``token:``
or ``IBAN``, access key ids, and ``@name`` handles).

Null and empty texts have no spans. Positions are code points, the end exclusive. Repeated rows each get their
own, equal result; other columns are left as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))

#: Words before an identifier.
CUES = (
    "password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key", "access_key", "account", "acct",
    "iban", "ssn", "passport", "username", "user_id",
)
#: Path segments after which a person's name stands.
PERSON = ("~", "@", "u/", "user/", "users/", "profile/", "people/", "in/")
SCHEMES = ("http", "https", "ftp", "ftps", "sftp", "ssh")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
HANDLE = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,30}(?![A-Za-z0-9_.@-])")
URL = re.compile(r"(?:[^\s/?#@\"'<>]*@)?([A-Za-z0-9.-]+)(?::[0-9]+)?(/[^\s\"'<>]*)?")
VALUE = re.compile(r"[ _-]?(?:key|id|no|number)?\.?[ \t]{0,3}[:=#][ \t]{0,3}[\"']?([A-Za-z0-9][A-Za-z0-9_+/-]{5,})")
IBAN = re.compile(r"[ \t:=#]{1,4}([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SSN = re.compile(r"[ \t:=#]{1,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban(value: str) -> bool:
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


@lru_cache(maxsize=1)
def anchors():
    import ahocorasick

    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("plus", 2))
    a.add_word("@", ("at", 1))
    a.add_word("://", ("scheme", 3))
    a.add_word("AKIA", ("access", 4))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            a.add_word(form, ("cue:" + cue, len(form)))
    a.make_automaton()
    return a


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by start, then by the order of KINDS."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # per kind, where the last match, kept or dropped, ended

    def keep(kind: str, start: int, end: int, good: bool = True) -> None:
        done[kind] = end
        if good:
            out.append((kind, start, end))

    card_seen = 0
    for last, (what, size) in anchors().iter(text):
        at = last - size + 1
        if what == "digit":
            if at >= card_seen:
                m = CARD.match(text, at)
                card_seen = m.end() if m else at + 1
                if m and card_seen - at >= 14:
                    digits = NOT_DIGIT.sub("", m[0])
                    keep("card", at, card_seen, 14 <= len(digits) <= 19 and luhn(digits))
            if at == done["ip"] or at > done["ip"] and not "0" <= text[at - 1] <= "9":
                if m := IP.match(text, at):
                    keep("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()))
        elif what == "plus":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                keep("phone", at, m.end(), 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15)
        elif what == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                keep("email", start, m.end())
            elif start == at and at >= done["account"] and (not at or text[at - 1] in " \t\n(,;:") and (m := HANDLE.match(text, at + 1)):
                keep("account", at, m.end())
        elif what == "scheme":
            start = at
            while start > done["address"] and at - start < 8 and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            m = URL.match(text, at + 3)
            if m and text[start:at].lower() in SCHEMES and at >= done["address"]:
                path = (m[2] or "/")[1:]
                personal = text[at + 3 : m.start(1)].endswith("@") or any(path.startswith(p) and len(path) > len(p) for p in PERSON)
                keep("address", start, m.end(), personal and "." in m[1])
        elif what == "access":
            if at >= done["account"] and (not at or not text[at - 1].isalnum()) and (m := ACCESS.match(text, at)):
                keep("account", at, m.end())
        elif at >= done["account"] and (not at or not text[at - 1].isalnum()):
            if what == "cue:iban":
                if (m := IBAN.match(text, last + 1)) and iban(m[1]):
                    keep("account", *m.span(1))
            elif what == "cue:ssn":
                if m := SSN.match(text, last + 1):
                    keep("account", *m.span(1))
            elif (m := VALUE.match(text, last + 1)) and any("0" <= c <= "9" for c in m[1]):
                keep("account", *m.span(1))
    order = {k: i for i, k in enumerate(KINDS)}
    out.sort(key=lambda s: (s[1], order[s[0]]))
    return out


def mask(text: str | None) -> str | None:
    """The text with every span replaced by ``[KIND]``; overlapping spans become one, named by the first."""
    spans = find(text)
    if not spans:
        return text
    parts, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            parts += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(parts) + text[end:]


@F.pandas_udf(SPANS)
def _spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in s], index=s.index, dtype=object)


@F.pandas_udf(T.StringType())
def _masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(mask, na_action="ignore")


def spans(text: Column) -> Column:
    """Array of (kind, start, end) found in a text column."""
    return _spans(text)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with the spans in `text_col` replaced by their kind in brackets; null stays null."""
    return df.withColumn(text_col, _masked(F.col(text_col)))


def report(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): counts per base kind, the digest of the base spans and all spans as text."""
    found = docs.select("doc_id", spans(F.col("text")).alias("s"))
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of = lambda k: F.size(F.filter("s", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("s", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[of(k) for k in BASE],
        F.sha2(F.array_join(F.transform(base, as_text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("s", as_text), ",").alias("spans"),
    )
