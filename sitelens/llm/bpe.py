"""BPE encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Splitting off a pre-token, the merges of a byte-level BPE define for every prefix one last token:
the encoding of a prefix is the encoding of the prefix before that token, and the token. A token
may follow another only if the merges of both together give the two back (`_Merges.may_follow`), and
of all ways to cut a pre-token into tokens just one lets every token follow the one before it.

A long pre-token is read one byte at a time. Of each of the last `lookahead` positions the last token of
the prefix that ends there is kept. `lookahead` is the length of the longest token that the merge list
can make: whatever follows, the next token starts at one of these positions. Tokens on which the paths
to all of them agree are stable and are emitted, so the state is bounded for a pre-token of any
length. A pre-token that fits the lookahead is known to its end, so its one way is searched forward:
the longest token that may follow, then shorter ones, going back where none can. Finished pieces are
remembered in a bounded table.

Long texts are encoded in sections that end before a single space, where a pre-token always begins.
Ids leave a section as they are made; the decoder turns them back into bytes and bytes into text with an
incremental UTF-8 machine, and an incomplete or wrong sequence becomes U+FFFD. So digests of a text need
no more than a section of it besides the text.

Cases: a null or empty text has no tokens and decodes to an empty text. Text that spells a special
token is that token, as in the library whose results these are.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import keeps_tables, map_batches, texts

#: Fixed value: the pre-token pattern of byte-level BPE with contractions.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    r" ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Pieces between spaces whose ids a worker remembers, twice; longer ones are not remembered.
REMEMBERED, LONG_PIECE = 300_000, 64
#: Pairs of tokens of which a worker remembers whether they may follow each other, twice.
REMEMBERED_PAIRS = 150_000

#: Characters after which a section of a text ends at the next single space.
SECTION = 1 << 16

SCHEMA = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars long"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Merges:
    """The merge list: which token two tokens make, and what a token was made of."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()}
        self.base = [0] * 256
        for letter, value in letters.items():
            self.base[value] = vocabulary[letter]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            pair = vocabulary[left], vocabulary[right]
            whole = vocabulary[left + right]
            self.rank[pair], self.made[pair] = rank, whole
            self.parts.setdefault(whole, (rank, *pair))
        # Whether a token may follow another, in two halves as in `_Pieces`.
        self.follow: dict[int, bool] = {}
        self.older: dict[int, bool] = {}
        reached = {i: b for i, b in self.bytes_of.items() if self.merged(b) == [i]}
        self.token = {b: i for i, b in reached.items()}
        self.size = {i: len(b) for i, b in reached.items()}
        self.lookahead = max(map(len, self.token))
        self._plant()

    def _plant(self) -> None:
        """A trie of the tokens: the node that a node and a byte lead to, the longest token on the way
        to a node (or -1), and of every token the longest one that it begins with."""
        self.forward: dict[int, int] = {}
        self.longest: list[int] = [-1]
        self.shorter: dict[int, int] = {}
        # In this order a token's beginnings are planted before it.
        for data, i in sorted(self.token.items()):
            node = 0
            for byte in data:
                before = self.longest[node]
                node = self.forward.setdefault(node << 8 | byte, len(self.longest))
                if node == len(self.longest):
                    self.longest.append(before)
            self.longest[node], self.shorter[i] = i, before

    @functools.cached_property
    def backward(self) -> tuple[dict[int, int], list[int]]:
        """A trie of the tokens read backwards, made for the first long pre-token: the node that a node
        and a byte lead to, and the token that begins there (or -1)."""
        step: dict[int, int] = {}
        beginning = [-1]
        for data, i in self.token.items():
            node = 0
            for byte in reversed(data):
                node = step.setdefault(node << 8 | byte, len(beginning))
                if node == len(beginning):
                    beginning.append(-1)
            beginning[node] = i
        return step, beginning

    def merged(self, data: bytes) -> list[int]:
        """Encode by applying the merges in order; only for single tokens, to see which exist."""
        ids = [self.base[b] for b in data]
        while len(ids) > 1:
            best = min(zip(ids, ids[1:], strict=False), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == best:
                    out.append(self.made[best])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together.

        The merges inside both are undone from the last to the first. Whenever the two parts that
        then touch have a merge of an earlier rank than the step undone, that merge would have
        come first and joined them.
        """
        key = left << 32 | right
        known = self.follow.get(key)
        if known is None:
            if len(self.follow) >= REMEMBERED_PAIRS:
                self.follow, self.older = {}, self.follow
            known = self.older.get(key)
            if known is None:
                known = self._apart(left, right)
            self.follow[key] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        rank, parts = self.rank, self.parts
        # A merge across the border wins against one of the same rank on its right only.
        limit = (1 << 60, 0)
        while True:
            across = rank.get((left, right))
            if across is not None and (across, 1) < limit:
                return False
            a = parts[left][0] if left in parts else -1
            b = parts[right][0] if right in parts else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = (a, 0), parts[left][2]
            else:
                limit, right = (b, 2), parts[right][1]


class Transducer:
    """Bytes of one pre-token in, tokens out as soon as they are stable."""

    def __init__(self, merges: _Merges):
        self.merges = merges
        self.start()

    def run(self, data: bytes) -> list[int]:
        """All tokens of a pre-token."""
        if not data:
            return []
        token = self.merges.token.get(data)
        if token is not None:
            return [token]
        if len(data) > self.merges.lookahead:
            return [*self.feed(data), *self.finish()]
        return self._search(data)

    def _search(self, data: bytes) -> list[int]:
        """The tokens of a pre-token that is known to its end.

        The tokens so far can follow each other. Where no token can come next, the last one was wrong
        and so is the place where it ends.
        """
        merges = self.merges
        size, shorter, longest = merges.size, merges.shorter, merges.longest
        step, follow = merges.forward.get, merges.follow.get
        found: list[int] = []
        wrong: set[int] = set()
        place, end, left, token = 0, len(data), -1, -1
        while place < end:
            if token < 0:
                node = 0
                for byte in data[place:]:
                    after = step(node << 8 | byte)
                    if after is None:
                        break
                    node = after
                token = longest[node]
            while token >= 0:
                if place + size[token] not in wrong:
                    if left < 0:
                        break
                    apart = follow(left << 32 | token)
                    if apart is None:
                        apart = merges.may_follow(left, token)
                    if apart:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                place += size[token]
                left, token = token, -1
                continue
            wrong.add(place)
            while token < 0:
                last = found.pop()
                place -= size[last]
                token = shorter[last]
                if token < 0:
                    wrong.add(place)
            left = found[-1] if found else -1
        return found

    def start(self) -> None:
        self.seen = b""  # bytes that no emitted token covers
        self.last = [-1]  # the last token of each prefix of `seen`; -1 before the first
        self.before = -1  # the token emitted last

    def _read(self, part: bytes) -> None:
        """Find the last token of every longer prefix: the longest that may follow what its own start
        ends with. The tokens that end at a position are found by reading backwards from it."""
        merges, last = self.merges, self.last
        (backward, beginning), may_follow = merges.backward, merges.may_follow
        done = len(self.seen)
        self.seen = seen = self.seen + part
        for end in range(done + 1, len(seen) + 1):
            node, token = 0, -1
            for begin in range(end - 1, -1, -1):
                node = backward.get(node << 8 | seen[begin])
                if node is None:
                    break
                t = beginning[node]
                if t >= 0:
                    left = last[begin] if begin else self.before
                    if left == -1 or may_follow(left, t):
                        token = t
            last.append(token)

    def feed(self, data: bytes) -> Iterator[int]:
        longest = self.merges.lookahead
        for start in range(0, len(data), longest):
            self._read(data[start : start + longest])
            if len(self.seen) >= 2 * longest:
                yield from self._stable()

    def _path(self, end: int) -> list[int]:
        """The ends of the tokens that lead to a position."""
        ends, size, last = [], self.merges.size, self.last
        while end > 0:
            ends.append(end)
            end -= size[last[end]]
        return ends[::-1]

    def _stable(self) -> Iterator[int]:
        """Emit what the paths to all positions in reach share.

        Each path leads from a position to the begin of its last token. From the last position
        backwards, positions that lie on a path are passed on to where they lead, until one is left
        that all have reached.
        """
        n, size, last = len(self.seen), self.merges.size, self.last
        open_ = set(range(n - self.merges.lookahead + 1, n + 1))
        end = n
        while len(open_) > 1:
            if end in open_:
                open_.discard(end)
                open_.add(end - size[last[end]])
            end -= 1
        (shared,) = open_
        if shared:
            ends = self._path(shared)
            yield from (last[end] for end in ends)
            self.before = last[shared]
            self.seen = self.seen[shared:]
            self.last = [-1, *last[shared + 1 :]]

    def finish(self) -> list[int]:
        ids = [self.last[end] for end in self._path(len(self.seen))]
        self.start()
        return ids


class Decoder:
    """Ids in, text out as soon as its bytes are complete."""

    def __init__(self, bytes_of: list[bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


class _Pieces(dict):
    """The ids of pieces of text as packed integers, made when first asked for.

    When it is full it becomes the older half and only what is asked for again moves on, so memory
    is bounded and frequent pieces stay.
    """

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > LONG_PIECE:
            return self.make(piece)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        self[piece] = ids
        return ids


class Encoder:
    """A vocabulary with its merges, and special tokens that are found in the text."""

    def __init__(self, definition: str):
        read = json.loads(definition)
        model = read["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = _Merges(model["vocab"], pairs)
        self.special = {t["content"]: t["id"] for t in read.get("added_tokens", ())}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, names))) if names else None
        table = self.merges.bytes_of | {i: t.encode() for t, i in self.special.items()}
        self.bytes_of = [table.get(i, b"") for i in range(max(table) + 1)]
        self.transducer = Transducer(self.merges)
        self.pre_token = regex.compile(PRE_TOKEN)
        self.pieces = _Pieces(self._make)

    def _make(self, piece: str) -> bytes:
        found = self.pre_token.findall(piece)
        if len(found) > 1:
            return b"".join(map(self.pieces.__getitem__, found))
        return array("I", self.transducer.run(piece.encode())).tobytes()

    def stream(self, text: str) -> Iterator[int]:
        """Tokens of a text without special tokens, pre-token by pre-token."""
        for match in self.pre_token.finditer(text):
            yield from self.transducer.run(match[0].encode())

    def _plain(self, text: str) -> bytes:
        """The ids of a text without special tokens, packed.

        Up to two white-space characters before another character are pre-tokens of their own or
        start one, so a text without longer runs can be cut before every space and around every
        line feed, and its pieces encoded on their own.
        """
        pieces = self.pieces
        if _ODD_SPACE.search(text) or any(x in text for x in _RUNS) or text[-1:] in " \n":
            parts = [m[0] for m in self.pre_token.finditer(text)]
        else:
            parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(pieces.__getitem__, parts))

    def packed(self, text: str) -> Iterator[bytes]:
        """The ids of a text, section by section, as packed 32-bit integers."""
        for section in sections(text):
            end = 0
            if self.special_pattern is not None and any(x in section for x in self.special):
                for match in self.special_pattern.finditer(section):
                    yield self._plain(section[end : match.start()])
                    yield array("I", [self.special[match[0]]]).tobytes()
                    end = match.end()
            yield self._plain(section[end:] if end else section)

    def encode(self, text: str) -> list[int]:
        return array("I", b"".join(self.packed(text))).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        decoder = Decoder(self.bytes_of)
        return decoder.feed(ids) + decoder.finish()


#: A space that begins a pre-token whatever is around: one between two characters that are no white space.
_CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """A text in parts that end before a single space; a part without any stays whole."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


#: White space other than the space and the line feed, and the byte that marks cuts.
_ODD_SPACE = re.compile("[\0\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_RUNS = ("  ", "\n\n", " \n", "\n ")


@functools.lru_cache(maxsize=4)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


keeps_tables(__name__, encoder.cache_clear)


def encode(rows: DataFrame, definition: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The token ids of every text, and the text that they decode to.

    `definition` is the content of a tokenizer file (JSON). One row per row of `rows`: doc_id, ids
    (none for a null or empty text), decoded.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(definition)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = encoder(shipped.value)
        ids = [tool.encode(t) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(tool.decode, ids))],
            names=["doc_id", "ids", "decoded"],
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, "doc_id long, ids array<int>, decoded string")


def digests(rows: DataFrame, definition: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What `encode` gives, as digests: the ids never leave the task that made them."""
    shipped = rows.sparkSession.sparkContext.broadcast(definition)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = encoder(shipped.value)
        names = decimal_names(len(tool.bytes_of))
        counts, ids_hash, text_hash, lengths = [], [], [], []
        for t in texts(batch.column(1)):
            n = chars = 0
            ids_sha, text_sha = hashlib.sha256(), hashlib.sha256()
            decoder = Decoder(tool.bytes_of)
            for packed in tool.packed(t):
                if packed:
                    ids = array("I", packed)
                    joined = ",".join(map(names.__getitem__, ids))
                    ids_sha.update(f",{joined}".encode() if n else joined.encode())
                    n += len(ids)
                    part = decoder.feed(ids)
                    chars += len(part)
                    text_sha.update(part.encode())
            part = decoder.finish()
            text_sha.update(part.encode())
            counts.append(n)
            lengths.append(chars + len(part))
            ids_hash.append(ids_sha.hexdigest())
            text_hash.append(text_sha.hexdigest())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(ids_hash, pa.string()),
                pa.array(text_hash, pa.string()),
                pa.array(lengths, pa.int64()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chars"],
        )

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, SCHEMA)


@functools.lru_cache(maxsize=4)
def decimal_names(count: int) -> list[str]:
    return list(map(str, range(count)))
