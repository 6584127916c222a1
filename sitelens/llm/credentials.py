"""Secrets, and parts of credentials that count only together.

Strong parts are found on their own: assignments to a secret's name, access identifiers with a
known prefix, long hexadecimal strings. Weak parts are not reported alone: names of users and
clients, random looking strings, addresses of services. A scope is a section of a text between
blank lines. Every part reaches over its whole scope; whether a complementary part that does not
overlap it lies there is told by the scope's last start and first end, and no pairs are made. A weak
part is reported when a part of another role (identifier, secret, endpoint) lies in reach, and one
of both is a secret. `spans` on its own keeps to a shorter reach unless told otherwise; then the
interval join is a merge of two sorted lists, and only the nearest complementary part counts.

Cases: a null or empty text has no spans; parts that touch or repeat are kept each; equal rows
give equal results; the state is the parts of one text.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import map_batches, texts

Span = tuple[str, int, int]

#: Kinds in the order that breaks ties of equal starts; the first three are the base.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "linked_identifier", "linked_secret", "linked_endpoint")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

#: Code points that a part reaches to either side within its scope where `spans` is not given another
#: reach; search and redaction of tables use the whole scope.
REACH = 160
#: Least bits per character of a random looking string.
RANDOM_BITS = 3.5

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
#: Without one of these in the text, in any case, there is no assignment.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_IDENTIFIER = re.compile(
    r"\b(?:user(?:name)?|login|client_?id|account_?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9@._-]{3,})",
    re.IGNORECASE | re.ASCII,
)
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])", re.ASCII)
_ADDRESS = re.compile(
    r"[a-z][a-z0-9+]*://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?", re.IGNORECASE | re.ASCII
)
_SERVICE = re.compile(
    r"\b(?:host|endpoint|server|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::[0-9]+)?",
    re.IGNORECASE | re.ASCII,
)
_BLANK_LINE = re.compile(r"\n[ \t]*\n")


def base_spans(text: str) -> list[Span]:
    """Strong parts: leftmost, non-overlapping per kind; matches that are too short are dropped."""
    found: list[Span] = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    # A run of at least 32 is a maximal run: the search starts at its first character.
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def looks_random(string: str) -> bool:
    """Letters and digits mixed, with many different characters."""
    if not (any(c.isdigit() for c in string) and any(c.isalpha() for c in string)):
        return False
    n = len(string)
    return -sum(c / n * math.log2(c / n) for c in Counter(string).values()) >= RANDOM_BITS


def weak_parts(text: str) -> dict[str, list[tuple[int, int]]]:
    return {
        "identifier": [m.span(1) for m in _IDENTIFIER.finditer(text)],
        "secret": [m.span() for m in _RANDOM.finditer(text) if looks_random(m[0])],
        "endpoint": endpoints(text),
    }


def endpoints(text: str) -> list[tuple[int, int]]:
    """Addresses with a scheme, and names of services with a value, leftmost and not overlapping.

    Addresses are looked for at their "://" and grown to the left, so that text without any is not
    tried at every word.
    """
    found = []
    place, mark = 0, text.find("://")
    service = _SERVICE.search(text)
    while mark >= 0 or service is not None:
        address = None
        if mark >= 0:
            begin = _scheme(text, place, mark)
            address = None if begin is None else _ADDRESS.match(text, begin)
            if address is None:
                mark = text.find("://", mark + 1)
                continue
        if address is not None and (service is None or address.start() <= service.start()):
            found.append(address.span())
        elif service is not None:
            found.append(service.span())
        place = found[-1][1]
        if 0 <= mark < place:
            mark = text.find("://", place)
        if service is not None and service.start() < place:
            service = _SERVICE.search(text, place)
    return found


def _scheme(text: str, place: int, mark: int) -> int | None:
    """The first place, from `place` on, at which a scheme that ends at a mark can begin."""
    begin = mark
    while begin > place and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] == "+")):
        begin -= 1
    for at in range(begin, mark):
        if text[at].isalpha() and (at == 0 or not _word_character(text[at - 1])):
            return at
    return None


def _word_character(character: str) -> bool:
    return character.isascii() and (character.isalnum() or character == "_")


def within_reach(
    parts: list[tuple[int, int]], others: list[tuple[int, int]], reach: int
) -> list[tuple[int, int]]:
    """Those parts with one of the others at most `reach` away, by a join of sorted intervals.

    Others are sorted by start with a running maximum of ends. A part overlapping its partner is
    the same string under two names and does not count.
    """
    others = sorted(others)
    starts = [s for s, _ in others]
    found = []
    for start, end in parts:
        right = bisect.bisect_left(starts, end)
        near = right < len(starts) and starts[right] - end <= reach
        left = right - 1
        while not near and left >= 0 and starts[left] > start - reach - LONGEST:
            near = others[left][1] <= start and start - others[left][1] <= reach
            left -= 1
        if near:
            found.append((start, end))
    return found


def within_scope(
    parts: list[tuple[int, int]], others: list[tuple[int, int]]
) -> list[tuple[int, int]]:
    """Those parts with one of the others, anywhere, that does not overlap them."""
    if not others:
        return []
    last, first = max(s for s, _ in others), min(e for _, e in others)
    return [(start, end) for start, end in parts if last >= end or first <= start]


#: Parts are at most so long; longer ones are cut into several for the join.
LONGEST = 4096


def _cut(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [(s, min(e, s + LONGEST)) for b, e in parts for s in range(b, e, LONGEST)]


def spans(text: str, reach: int | None = REACH) -> list[Span]:
    """All spans, by start and then by kind as listed; a reach of None is the whole scope."""
    found = base_spans(text)
    strong = {(s, e) for _, s, e in found}
    weak = weak_parts(text) if _may_link(text, found) else {}
    if weak:
        covered = sorted(strong)
        firsts = [s for s, _ in covered]

        def free(part: tuple[int, int]) -> bool:
            """Not inside a strong part, which is reported already."""
            i = bisect.bisect_left(firsts, part[1]) - 1
            return all(e <= part[0] for _, e in covered[max(0, i - 2) : i + 1])

        weak = {role: [p for p in parts if free(p)] for role, parts in weak.items()}
        roles = {
            "identifier": weak["identifier"] + [(s, e) for k, s, e in found if k == "access"],
            "secret": weak["secret"] + [(s, e) for k, s, e in found if k in ("assign", "hex")],
            "endpoint": weak["endpoint"],
        }
        edges = [0, *[m.start() for m in _BLANK_LINE.finditer(text)], len(text) + 1]
        linked: list[Span] = []
        for here, mine in _by_scope(roles, weak, edges):

            def near(parts, others, reach=reach):
                if reach is None:
                    return within_scope(parts, others)
                return within_reach(parts, _cut(others), reach)

            for role in ("identifier", "endpoint"):
                linked += [(f"linked_{role}", *p) for p in near(mine[role], here["secret"])]
            linked += [
                ("linked_secret", *p)
                for p in near(mine["secret"], here["identifier"] + here["endpoint"])
            ]
        found += linked
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


Parts = dict[str, list[tuple[int, int]]]


def _by_scope(roles: Parts, weak: Parts, edges: list[int]) -> Iterator[tuple[Parts, Parts]]:
    """The parts of every scope that has some, in one walk along the sorted parts and edges."""
    scopes: dict[int, tuple[Parts, Parts]] = {}
    for which, lists in enumerate((roles, weak)):
        for role, parts in lists.items():
            scope = 0
            for part in sorted(parts):
                while edges[scope + 1] <= part[0]:
                    scope += 1
                if scope not in scopes:
                    scopes[scope] = ({r: [] for r in roles}, {r: [] for r in weak})
                scopes[scope][which][role].append(part)
    yield from scopes.values()


def _may_link(text: str, found: list[Span]) -> bool:
    """An identifier or an endpoint is needed for any link: without its marks there is none."""
    return "://" in text or ":" in text or "=" in text or any(k == "access" for k, *_ in found)


def find(rows: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The spans of every text, one row per row of `rows`: doc_id, spans (kind, start, end)."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"kind": k, "start": s, "end": e} for k, s, e in spans(t, None)]
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


def redacted(text: str, mark: str = "<secret>") -> str:
    """The text with every stretch of secret spans, linked over whole scopes, replaced by a mark."""
    out, end = [], 0
    stretch = None
    for _, s, e in spans(text, None):
        if stretch and s < stretch[1]:
            stretch[1] = max(stretch[1], e)
        else:
            if stretch:
                out += [text[end : stretch[0]], mark]
                end = stretch[1]
            stretch = [s, e]
    if stretch:
        out += [text[end : stretch[0]], mark]
        end = stretch[1]
    return "".join([*out, text[end:]])


def redact(rows: DataFrame, *, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, with secrets in the text replaced.

    The length column, if there is one, follows the new text; it stays where nothing was found,
    and where the text is null.
    """
    schema = rows.schema
    at = schema.fieldNames().index(text)
    size = schema.fieldNames().index(length) if length in schema.fieldNames() else None

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = batch.column(at).to_pylist()
        after = [None if t is None else redacted(t) for t in before]
        columns = list(batch.columns)
        columns[at] = pa.array(after, columns[at].type)
        if size is not None:
            lengths = columns[size].to_pylist()
            lengths = [
                n if a == b else len(a)
                for n, a, b in zip(lengths, after, before, strict=True)
            ]
            columns[size] = pa.array(lengths, columns[size].type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(rows, apply, schema)
