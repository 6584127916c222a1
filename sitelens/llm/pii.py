"""Personal data by anchors: an Aho-Corasick automaton finds at-signs, plus signs, digits, schemes
and account cues in one pass, and a small deterministic parser grows each anchor to its borders.

What the parsers accept, per kind, is stated with them. The first four kinds are those of the
contract; `url` and `account` are added by the cues. Spans of one kind never overlap. Offsets are
code points, the end is exclusive.

Cases: a null or empty text has no spans; equal rows give equal results; any length is scanned
whole, with a state of a few integers per kind.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import map_batches, texts

Span = tuple[str, int, int]

#: Kinds in the order of the digest; the first four are the base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ftps://")
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:[/?#][^\s<>\"'|]*)?")
_ACCOUNT = re.compile(
    r"(?:[ ._-]?(?:no|nr|number|num|id)\.?)?[ ]?[:#=]?[ ]?((?:[A-Z]{2}[0-9]{2})?[0-9](?:[ -]?[0-9A-Z])*)"
)
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    """Anchors and what to do at each. Cues also match in capitals."""
    found = ahocorasick.Automaton()
    for anchor in ("@", "+"):
        found.add_word(anchor, (anchor, 1))
    for digit in "0123456789":
        found.add_word(digit, ("0", 1))
    for scheme in SCHEMES:
        for form in {scheme, scheme.upper()}:
            found.add_word(form, ("url", len(form)))
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("account", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        if i % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def spans(text: str) -> list[Span]:
    """All spans of a text, by kind as listed and then by start."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    email = ip = card = phone = url = account = 0  # where the next match of a kind may start
    for end, (what, length) in _automaton().iter(text):
        start = end + 1 - length
        if what == "0":
            # An anchor inside a run of digits starts nothing new, unless a match ended there.
            if start >= ip:
                match = _IP.match(text, start)
                if match:
                    ip = match.end()
                    parts = [p.lstrip("0") or "0" for p in match[0].split(".")]
                    if all(len(p) < 4 and int(p) <= 255 for p in parts):
                        found["ip"].append(("ip", start, ip))
                else:
                    # No later digit of this run starts an address either.
                    ip = _DIGITS.match(text, start).end()
            if start >= card:
                match = _CARD.match(text, start)
                card = match.end() if match else start + 1
                if match:
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(("card", start, card))
        elif what == "@":
            # Grow to the left up to the last match, to the right over at least two labels.
            match = _DOMAIN.match(text, end + 1)
            if match:
                left = start
                while left > email and text[left - 1] in _LOCAL_CHARS:
                    left -= 1
                if left < start:
                    email = match.end()
                    found["email"].append(("email", left, email))
        elif what == "+":
            if start >= phone:
                match = _PHONE.match(text, start)
                if match:
                    phone = match.end()
                    if 9 <= sum(c in "0123456789" for c in match[0]) <= 15:
                        found["phone"].append(("phone", start, phone))
        elif what == "url":
            # A scheme that is not the end of a longer word, a host of two labels, a path.
            if start >= url and not (start and text[start - 1].isalnum()):
                match = _URL.match(text, end + 1)
                if match:
                    url = end + 1 + len(match[0].rstrip(".,;:!?)]}"))
                    found["url"].append(("url", start, url))
        elif start >= account and not (start and text[start - 1].isalpha()):
            # A cue as a word, then a number of six to thirty-four letters and digits.
            match = _ACCOUNT.match(text, end + 1)
            if match:
                size = sum(c.isalnum() for c in match[1])
                if 6 <= size <= 34:
                    account = match.end(1)
                    found["account"].append(("account", match.start(1), account))
    return [span for kind in KINDS for span in found[kind]]


def find(rows: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The spans of every text, one row per row of `rows`: doc_id, spans (kind, start, end)."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"kind": k, "start": s, "end": e} for k, s, e in spans(t)]
            for t in texts(batch.column(1))
        ]
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"]
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def digest(found: DataFrame, base: tuple[str, ...], **counts: str) -> DataFrame:
    """Columns of the contract from spans that are in their final order.

    `counts` names a column for each base kind that is counted. The order of base spans is the
    order of all spans, without the added kinds.
    """
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    inside = lambda s: s["kind"].isin(*base)

    def of_kind(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    return found.select(
        "doc_id",
        *[
            F.size(of_kind(kind)).cast("long").alias(name)
            for name, kind in counts.items()
        ],
        F.sha2(
            F.concat_ws(",", F.transform(F.filter("spans", inside), line)), 256
        ).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", line)).alias("spans"),
    )
