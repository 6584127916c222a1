"""A class-based bigram language model: exchange clustering, transitions of classes, emissions.

The probability of a text is the product over its words, and a final end, of
p(class | class before) * p(word | class). All words of the training texts are dealt to classes by
the exchange algorithm: a word moves to the class in which the mutual information of neighbouring
classes is largest. The most frequent words go first, one after another on the driver, until none
moves. From these classes all words are exchanged in tasks, each against the class pairs as they
were when the pass began, until none moves or a pass raises the mutual information by less than
`Settings.least_gain` per token. Words that move at once do not see each other, so half of them move
in a pass, and half as many from then on if the information went down; no such pass is kept. Only words that no
training text has get a class by their form (length, last letter, digits, symbols, letters beyond
ASCII): the one that holds most training words of that form. Emissions are counts of all words of the
corpus, with one unseen word per class; transitions are interpolated with the frequency of the class.

Counts, neighbours and classes of words cover the whole corpus and grow with it: they stay in
distributed tables, keyed by a 64-bit hash. Neighbours lie in parts of the words, which are dealt once and
are not shuffled again: passes send each part the classes of the words next to its own. To score, texts are
cut into chunks by a hash of id and text. A chunk's distinct words meet their counts and classes by a join on the word, and go back to the
chunk, which is scored as a whole. So a frequent word is one row per chunk, and a chunk's size is
bounded by `Settings.chunk_bytes` on average, whatever the number of texts. What is collected are the
counts of the `Settings.exchanged` words that go first and of pairs among these, of pairs of classes,
and of forms.

Cases: a null or empty text is an end only; repeated rows count and are scored each; without texts
to learn from, every token has base score 0 and only the choice of its class costs the model
something; words are lower-cased (A-Z) and separated by ASCII white space.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FORMS = 4 * 6 * 4


#: The end of a text among the words.
_END = int(np.iinfo(np.int64).min)
#: Counts up to here have their gains in a table.
_STEPS = 16
#: And up to here they are summed by a product of matrices, at most `_STEPS`.
_ONES = 3
#: The smallest share of words that moves in a pass, as a power of 1 / 2.
_HALVINGS = 5
#: Words whose gains are computed at once.
_ROWS = 2048
#: Bytes of text that are cut into words at once.
_PIECE = 1 << 20
#: Words that are hashed at once, as Python objects.
_HASHED = 1 << 16
#: By byte: a digit, an ASCII letter, other ASCII, beyond ASCII, as bits.
_KINDS = np.array(
    [1 if 48 <= b <= 57 else 2 if chr(b).isalpha() and b < 128 else 4 if b < 128 else 8 for b in range(256)], np.uint8
)
#: By last byte: a vowel, one of dnrst, another small letter, a digit, beyond ASCII, anything else.
_ENDS = np.array(
    [
        (0 if b in b"aeiou" else 1 if b in b"dnrst" else 2) if 97 <= b <= 122
        else 3 if 48 <= b <= 57 else 4 if b > 127 else 5
        for b in range(256)
    ]
)
#: Tasks that add up what the parts have counted.
_SLICES = 16
_PRIMES = np.array(
    [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5],
    np.uint64,
)


@dataclass(frozen=True)
class Settings:
    #: Words that are exchanged one after another before all are.
    exchanged: int = 1000
    classes: int = 40
    #: At most so many passes of either exchange; None is until the end.
    passes: int | None = None
    #: Mutual information per token, in nats, that a pass must bring, by the share of words that it
    #: moves, for another one to follow.
    least_gain: float = 1e-2
    #: Weight of the class frequency in a transition, and of the unseen word in an emission.
    transition_prior: float = 20.0
    emission_prior: float = 0.5
    chunk_bytes: int = 12 << 20


@dataclass(frozen=True)
class Block:
    """The tokens of some texts."""

    lengths: np.ndarray  # of texts
    numbers: np.ndarray  # of tokens, text after text
    words: pa.Array  # by number


def blocks(columns: Iterable[pa.Array], room: int) -> Iterator[Block]:
    """Texts cut into words, A-Z in lower case; a block ends with the piece that reaches `room` tokens.
    Null has no words."""
    lengths, tokens, size = [], [], 0
    for piece in itertools.chain.from_iterable(map(_pieces, columns)):
        lines = pc.ascii_split_whitespace(pc.ascii_lower(piece))
        found = lines.flatten().cast(pa.large_binary())
        # White space at either end of a text leaves an empty word.
        whole = pc.greater(pc.binary_length(found), 0)
        ends = np.cumsum(pc.list_value_length(lines).to_numpy())
        upto = np.concatenate([[0], np.cumsum(whole.to_numpy(zero_copy_only=False))])[ends]
        lengths.append(np.diff(upto, prepend=0))
        tokens.append(found.filter(whole))
        size += len(tokens[-1])
        del lines, found, whole
        if size >= room:
            yield _block(lengths, tokens)
            size = 0
    if lengths:
        yield _block(lengths, tokens)
    # Workers live as long as the session and would keep what Arrow holds free.
    pa.default_memory_pool().release_unused()


def _pieces(column: pa.Array) -> Iterator[pa.Array]:
    """Texts that follow each other, of `_PIECE` bytes or one text more."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    place = np.cumsum(pc.binary_length(texts).to_numpy()) // _PIECE
    cuts = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
    for begin, end in itertools.pairwise(cuts):
        yield texts.slice(begin, end - begin)


def _block(lengths: list[np.ndarray], tokens: list[pa.Array]) -> Block:
    """Empties both lists: the tokens are not held while the block is in use."""
    # Without any token there is no chunk.
    coded = pa.chunked_array(tokens).dictionary_encode().chunks or [tokens[0].dictionary_encode()]
    of = np.concatenate(lengths)
    tokens.clear()
    lengths.clear()
    return Block(of, np.concatenate([c.indices.to_numpy() for c in coded]), coded[0].dictionary)


def word_hashes(words: list[bytes] | pa.Array) -> np.ndarray:
    """64-bit hashes as signed integers."""
    words = pa.array(words, pa.large_binary()) if isinstance(words, list) else words
    found = np.zeros(len(words), np.int64)
    for i in range(0, len(words), _HASHED):
        some = words.slice(i, _HASHED).to_numpy(zero_copy_only=False)
        found[i : i + len(some)] = pd.util.hash_array(some, categorize=False).view(np.int64)
    return found


def forms(words: pa.Array) -> np.ndarray:
    """Classes of words (`large_binary`, none empty) by what they look like: length, last byte, and whether
    they have digits, are letters only, or go beyond ASCII."""
    if not len(words):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[: offsets[-1]]
    size = np.searchsorted([4, 7, 11], np.diff(offsets), side="right")
    held = np.bitwise_or.reduceat(_KINDS[data], offsets[:-1])
    kind = np.where(held & 1, 1, np.where(held == 2, 0, np.where(held & 8, 3, 2)))
    return (size * 6 + _ENDS[data[offsets[1:] - 1]]) * 4 + kind


def form(word: bytes) -> int:
    return int(forms(pa.array([word], pa.large_binary()))[0])


def _map(rows: DataFrame, function, schema: str) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)

    return rows.mapInArrow(apply, schema)


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )


def word_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """word, form, n over all texts (column `text`).

    Tasks count in blocks of bounded size before anything is shuffled.
    """
    room = settings.chunk_bytes // 6

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks((batch.column(0) for batch in batches), room):
            yield _batch(
                {
                    "word": (word_hashes(block.words), pa.int64()),
                    "form": (forms(block.words).astype(np.int32), pa.int32()),
                    "n": (np.bincount(block.numbers, minlength=len(block.words)), pa.int64()),
                }
            )

    counted = _map(texts.select("text"), apply, "word long, form int, n long")
    return counted.groupBy("word", "form").agg(F.sum("n").alias("n"))


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers with bytes of equal weight side by side, compressed; none for bytes that are 0 in all."""
    unsigned = np.ascontiguousarray(numbers, np.int64).view(np.uint64)
    width = (int(unsigned.max(initial=0)).bit_length() + 7) // 8
    planes = b"".join((unsigned >> np.uint64(8 * i)).astype(np.uint8).tobytes() for i in range(width))
    head = len(numbers).to_bytes(8, "little") + width.to_bytes(1, "little")
    return head + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: pa.Scalar) -> np.ndarray:
    data = packed.as_buffer()
    head = data.slice(0, 9).to_pybytes()
    count, width = int.from_bytes(head[:8], "little"), head[8]
    found = np.zeros(count, np.uint64)
    if count and width:
        planes = np.frombuffer(pa.decompress(data.slice(9), width * count, codec="zstd"), np.uint8)
        for i, plane in enumerate(planes.reshape(width, count)):
            found |= plane.astype(np.uint64) << np.uint64(8 * i)
    return found.view(np.int64)


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words.view(np.uint64) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of n of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n[order], starts) if len(starts) else n[:0]


def neighbours(texts: DataFrame, words: list[int], parts: int, settings: Settings) -> DataFrame:
    """The neighbours of all words, one row per part of the words; checkpointed, dealt by `part`.

    `words` go first and have their place as number; all others share the next number and the end, on
    both sides of a text, has the one after. A row has `words`: the words of the part but for those with
    numbers; `halo`: neighbours of these without a number; `degree`: entries of each word; for each
    entry `code` and `n`: code // 2 is the number of a neighbour, or, less the count of numbers, its
    place in the halo; code % 2 is 0 for one that follows and 1 for one that comes before. So a pair of
    words without numbers is in the rows of both. `at` and `count` are the share that this part has in
    the counts of pairs of numbers, at before * numbers + after.
    """
    room, others = settings.chunk_bytes // 6, len(words)
    numbers = others + 2
    sought = np.array([*words, _END], np.int64)
    order = np.argsort(sought)
    sought, named = sought[order], np.array([*range(others), others + 1])[order]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks((batch.column(0) for batch in batches), room):
            yield flushed(block)

    def flushed(block: Block) -> pa.RecordBatch:
        hashes = np.concatenate([[_END], word_hashes(block.words)])
        # The end is 0, before the first text and after each.
        series = np.zeros(len(block.numbers) + len(block.lengths) + 1, np.int64)
        text = np.repeat(np.arange(len(block.lengths)), block.lengths)
        text += np.arange(1, len(text) + 1)
        series[text] = block.numbers
        series[text] += 1
        del text
        at = np.minimum(np.searchsorted(sought, hashes), len(sought) - 1)
        number = np.where(sought[at] == hashes, named[at], others)
        pairs, n = np.unique(series[:-1] * len(hashes) + series[1:], return_counts=True)
        before, after = pairs // len(hashes), pairs % len(hashes)
        both = (number[before] != others) & (number[after] != others)
        first, first_n = _summed(number[before[both]] * numbers + number[after[both]], n[both])
        # Every entry lies with its word, words by part and hash.
        sides = number[before] == others, number[after] == others
        word = np.concatenate([before[sides[0]], after[sides[1]]])
        other = np.concatenate([after[sides[0]], before[sides[1]]])
        side = np.repeat([0, 1], [sides[0].sum(), sides[1].sum()])
        n = np.concatenate([n[sides[0]], n[sides[1]]])
        part = part_of(hashes, parts)
        ranks = np.empty(len(hashes), np.int64)
        ranked = np.lexsort((hashes, part))
        ranks[ranked] = np.arange(len(hashes))
        order = np.argsort(ranks[word], kind="stable")
        word, other, side, n = word[order], other[order], side[order], n[order]
        alone = number[other] == others
        code = 2 * np.where(alone, numbers, number[other]) + side
        cuts = np.searchsorted(part[word], np.arange(parts + 1))
        rows = []
        for p in range(parts):
            here = slice(cuts[p], cuts[p + 1])
            mine = first % parts == p
            if cuts[p] == cuts[p + 1] and not mine.any():
                continue
            starts = np.flatnonzero(np.diff(word[here], prepend=-1))
            degree = np.diff(starts, append=cuts[p + 1] - cuts[p])
            columns = hashes[word[here][starts]], degree, code[here], n[here], hashes[other[here][alone[here]]]
            rows.append((p, *map(_pack, (*columns, first[mine], first_n[mine]))))
        names = ("part", "words", "degree", "code", "n", "halo", "at", "count")
        kinds = [pa.int64()] + [pa.binary()] * 7
        return _batch({c: (list(v), k) for c, v, k in zip(names, zip(*rows), kinds)})

    def merged(table: pa.Table) -> pa.Table:
        degree, code, n, halo, at, count = (
            np.concatenate([_unpack(x) for x in table[c]]) for c in ("degree", "code", "n", "halo", "at", "count")
        )
        words, word = np.unique(np.concatenate([_unpack(x) for x in table["words"]]), return_inverse=True)
        halo, other = np.unique(halo, return_inverse=True)
        alone = code >= 2 * numbers
        code[alone] += 2 * other
        span = 2 * (numbers + len(halo))
        keys, n = _summed(np.repeat(word, degree) * span + code, n)
        code = keys % span
        # Pairs with words that have no number, and of these.
        number = np.where(code < 2 * numbers, code // 2, others)
        side = (code % 2).astype(bool)
        seen = ~side | (code < 2 * numbers)
        beside = np.where(side, number * numbers + others, others * numbers + number)
        at, count = _summed(np.concatenate([at, beside[seen]]), np.concatenate([count, n[seen]]))
        packed = words, halo, np.bincount(keys // span, minlength=len(words)), code, n
        return pa.table(
            {"part": table["part"][:1]}
            | {c: pa.array([_pack(x)], pa.binary()) for c, x in zip(("words", "halo", "degree", "code", "n"), packed)}
            | {"at": pa.array([at], pa.list_(pa.int64())), "count": pa.array([count], pa.list_(pa.int64()))}
        )

    found = _map(
        texts.select("text"),
        apply,
        "part long, words binary, degree binary, code binary, n binary, halo binary, at binary, count binary",
    )
    rows = found.groupBy("part").applyInArrow(
        merged,
        "part long, words binary, halo binary, degree binary, code binary, n binary, at array<long>, count array<long>",
    )
    # Only without adaptive execution a checkpoint remembers how it is dealt, and passes need no shuffle.
    conf = texts.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return rows.repartition(parts, "part").sortWithinPartitions("part").checkpoint()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _PRIMES[1]
    h = (h ^ (h >> np.uint64(29))) * _PRIMES[2]
    return h ^ (h >> np.uint64(32))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def moving(words: np.ndarray, halvings: int, turn: int) -> np.ndarray:
    """One word in 2 ** halvings, another share every turn: by xxhash64(word, turn), as Spark has it."""
    p = _PRIMES
    h = np.full(len(words), 42, np.uint64) + p[4] + np.uint64(8)
    h = _turned(h ^ (_turned(words.view(np.uint64) * p[1], 31) * p[0]), 27) * p[0] + p[3]
    h = _mixed(h) + p[4] + np.uint64(4)
    h = _mixed(_turned(h ^ (np.full(len(words), turn, np.uint64) * p[0]), 23) * p[1] + p[2])
    return h & np.uint64((1 << halvings) - 1) == 0


def _log(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def information(table: np.ndarray) -> float:
    """The part of the mutual information of neighbouring classes that depends on the classes."""
    return float(_log(table).sum() - _log(table.sum(axis=1)).sum() - _log(table.sum(axis=0)).sum())


@dataclass(frozen=True)
class Steps:
    """What small counts add to `information`, for a table of pairs of classes, on either side."""

    base: tuple[np.ndarray, np.ndarray]  # other class x class
    pairs: tuple[np.ndarray, np.ndarray]  # (count - 1) and other class x class
    total: tuple[np.ndarray, np.ndarray]
    totals: tuple[np.ndarray, np.ndarray]  # count x class

    @staticmethod
    def of(table: np.ndarray, k: int) -> Steps:
        base = tuple(np.ascontiguousarray(t[:k].T) for t in (table, table.T))
        total = tuple(t.sum(axis=1)[:k] for t in (table, table.T))
        few = np.arange(1, _STEPS + 1)[:, None, None]
        return Steps(
            base, tuple((_log(b + few) - _log(b)).reshape(-1, k) for b in base),
            total, tuple(_log(x + np.arange(_STEPS + 1)[:, None]) - _log(x) for x in total),
        )


def gains(
    right: np.ndarray, left: np.ndarray, own: np.ndarray, self_: np.ndarray, table: np.ndarray, k: int,
    steps: Steps | None = None,
) -> np.ndarray:
    """What every word, taken out of its own class, adds to `information` in each of k classes.

    `right` and `left` count the classes after and before each word, `self_` the word beside itself.
    Most counts are small or 0: logarithms are taken of the others, and where the word itself was counted.
    """
    steps = steps or Steps.of(table, k)
    words = np.arange(len(own))
    inside = np.flatnonzero(own < k)
    found = np.zeros((len(own), k))
    near = []
    for side, (mine, cross, t) in enumerate(((right, left, table), (left, right, table.T))):
        counts = mine.copy()
        counts[words, own] -= self_
        near.append(counts[:, :k])
        base, small = steps.base[side], steps.pairs[side]
        # The smallest counts, most of all, as one product.
        ones = np.concatenate([counts == a for a in range(1, _ONES + 1)], axis=1).astype(float)
        gain = ones @ small[: _ONES * len(base)]
        at = np.flatnonzero(counts > 0)
        i, c = np.divmod(at, counts.shape[1])
        a, o = counts.reshape(-1)[at], own[i]
        more = np.flatnonzero(a > _ONES)
        if len(more):
            term = small[(np.minimum(a[more], _STEPS).astype(np.int64) - 1) * len(base) + c[more]]
            many = np.flatnonzero(a[more] > _STEPS)
            term[many] = _log(base[c[more[many]]] + a[more[many], None]) - _log(base[c[more[many]]])
            first = np.flatnonzero(np.diff(i[more], prepend=-1))
            gain[i[more[first]]] += np.add.reduceat(term, first)
        # Cells that held the word itself: those of a neighbour's class on the other side with its own class,
        # and all of its own class.
        met = np.zeros(len(own))
        met[i[c == o]] = a[c == o]
        w, d = np.nonzero((cross[:, :k] > 0) & (met > 0)[:, None])
        held, with_ = base[own[w], d], met[w]
        gain[w, d] -= _log(held + with_) - _log(held)
        held = held - cross[w, d]
        gain[w, d] += _log(held + with_) - _log(held)
        at = np.flatnonzero(o < k)
        held = t[o[at], c[at]] - mine[i[at], c[at]]
        held -= np.where(c[at] == o[at], cross[i[at], o[at]] - self_[i[at]], 0.0)
        gain[inside, own[inside]] = np.bincount(i[at], _log(held + a[at]) - _log(held), len(own))[inside]
        n = mine.sum(axis=1)
        total = steps.total[side]
        more = steps.totals[side][np.minimum(n, _STEPS).astype(np.int64)]
        many = np.flatnonzero(n > _STEPS)
        more[many] = _log(total + n[many, None]) - _log(total)
        held = total[own[inside]]
        more[inside, own[inside]] = _log(held) - _log(held - n[inside])
        found += gain - more
    # Pairs of a class with itself, where the word has that class on both sides or is its own neighbour.
    both = (near[0] > 0) & (near[1] > 0)
    both[self_ > 0] = True
    w, d = np.nonzero(both)
    corner = np.diagonal(table)[d] - np.where(own[w] == d, right[w, d] + left[w, d] - self_[w], 0.0)
    after, before = near[0][w, d], near[1][w, d]
    found[w, d] += (
        _log(corner + after + before + self_[w]) - _log(corner + after) - _log(corner + before) + _log(corner)
    )
    return found


def _best(gain: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The class of most gain of each word; its own one if that is as good, and if it stays for good."""
    top = gain.max(axis=1)
    to = np.argmax(gain >= top[:, None] - 1e-6, axis=1)
    stays = np.flatnonzero(own < k)
    stays = stays[gain[stays, own[stays]] >= top[stays] - 1e-6]
    to[stays] = own[stays]
    return np.where(own == k + 1, own, to)


@dataclass(frozen=True)
class Moves:
    """Classes of all words: those from which some words have moved to the ones proposed."""

    proposed: DataFrame  # part, source, now, to, moved: for each part the words there and in its halo
    first: tuple[np.ndarray, np.ndarray]  # the same for the words with numbers
    halvings: int
    turn: int


@dataclass(frozen=True)
class _Part:
    """A row of `neighbours` with the present classes."""

    words: np.ndarray
    halo: np.ndarray
    word: np.ndarray  # of each entry
    code: np.ndarray
    n: np.ndarray
    classes: np.ndarray  # of words
    other_classes: np.ndarray  # of the neighbour in each entry


def _part(row: pa.Table, sent: pa.Table, first: np.ndarray, k: int, parts: int, step: tuple[int, int]) -> _Part:
    """`first` has the classes by number; `step` says which of the proposed moves are made."""
    words, halo, degree, code, n = (_unpack(row[c][0]) for c in ("words", "halo", "degree", "code", "n"))
    classes, near = np.full(len(words), k), np.full(len(halo), k)
    if sent.num_rows:
        # Words of the halo by the part that they come from.
        of = part_of(halo, parts)
        order = np.argsort(of.astype(np.uint16) if parts <= 1 << 16 else of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(parts + 1))
    for i, source in enumerate(sent["source"].to_pylist()):
        now, to = _unpack(sent["now"][i]), _unpack(sent["to"][i])
        at = np.arange(len(words)) if source < 0 else order[cuts[source] : cuts[source + 1]]
        found, hashes = (classes, words) if source < 0 else (near, halo)
        found[at] = now
        moved = np.flatnonzero(now != to)
        moved = moved[moving(hashes[at[moved]], *step)]
        found[at[moved]] = to[moved]
    return _Part(
        words, halo, np.repeat(np.arange(len(words)), degree), code, n, classes,
        np.concatenate([first, near])[code >> 1],
    )


def exchange_all(
    rows: DataFrame, parts: int, words: list[int], pairs: np.ndarray, member: np.ndarray, k: int, settings: Settings
) -> tuple[DataFrame, np.ndarray]:
    """word, class of all words, and the table of pairs of classes, where k + 1 has the end.

    `rows` are what `neighbours` gives and `pairs` its counts of pairs of numbers. `member` has the
    classes by number to start from; other words are in class k until the first pass has moved them to
    one of the k classes. A pass sends each part the classes of the words in its halo, not the pairs.
    """
    size, numbers, spark = k + 2, len(pairs), rows.sparkSession
    others = numbers - 2
    hashes = np.array([*words, 0, _END], np.int64)
    stored = rows.select("part", "words", "halo", "degree", "code", "n")
    known = np.arange(numbers) != others
    pairs = np.where(known[:, None] & known[None], pairs, 0)
    schema = "part long, source long, now binary, to binary, moved long"
    best, kept, done, halvings = -math.inf, None, 0, 1
    moves = Moves(spark.createDataFrame([], schema), (member, member), 0, 0)
    while True:
        step = moves.halvings, moves.turn
        first = np.where(moving(hashes, *step), moves.first[1], moves.first[0])

        def counted(row: pa.Table, sent: pa.Table) -> pa.Table:
            if not row.num_rows:
                return pa.table({"slice": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})
            x = _part(row, sent, first, k, parts, step)
            own = x.classes[x.word]
            cells = np.bincount((own * 2 + (x.code & 1)) * size + x.other_classes, x.n, 2 * size * size)
            cells = cells.reshape(size, 2, size)[:, 0].reshape(-1)
            near = np.flatnonzero(x.code < 2 * numbers)
            # The word follows a neighbour that comes before it.
            slots = (x.code[near] ^ 1) * size + own[near]
            counts = np.concatenate([cells, np.bincount(slots, x.n[near], 2 * numbers * size)])
            slices = [_pack(c) for c in np.array_split(counts.astype(np.int64), _SLICES)]
            return pa.table({"slice": np.arange(_SLICES), "counts": pa.array(slices, pa.binary())})

        def added(table: pa.Table) -> pa.Table:
            total = sum(_unpack(x) for x in table["counts"])
            return pa.table({"slice": table["slice"][:1], "counts": pa.array([_pack(total)], pa.binary())})

        grouped = stored.groupBy("part").cogroup(moves.proposed.groupBy("part"))
        found = (
            grouped.applyInArrow(counted, "slice long, counts binary")
            .groupBy("slice")
            .applyInArrow(added, "slice long, counts binary")
            .toArrow()
        )
        sides = np.zeros((numbers, 2, size))
        table = np.zeros((size, size))
        if found.num_rows:
            found = found.sort_by("slice")
            counts = np.concatenate([_unpack(x) for x in found["counts"]]).astype(float)
            table += counts[: size * size].reshape(size, size)
            sides += counts[size * size :].reshape(numbers, 2, size)
        np.add.at(sides[:, 0].T, first, pairs.T)
        np.add.at(sides[:, 1].T, first, pairs)
        np.add.at(table, first[known], sides[known, 0])
        open_ = table[k].any()
        if not open_:
            now = information(table)
            more = now - best
            if more <= 0 and halvings < _HALVINGS:
                # Too many moved at once: fewer of the same moves.
                halvings += 1
                moves = replace(moves, halvings=halvings)
                continue
            if more > 0:
                kept = moves, first, table
            if more <= 0 or more < settings.least_gain * table.sum() / 2**halvings or done == settings.passes:
                break
            best = now
        shipped = spark.sparkContext.broadcast(table)
        share, turn = 0 if open_ else halvings, done + 1

        def move(row: pa.Table, sent: pa.Table) -> pa.Table:
            names = ("part", "source", "now", "to", "moved")
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
            if not row.num_rows:
                return pa.table({c: pa.array([], t) for c, t in zip(names, kinds)})
            x = _part(row, sent, first, k, parts, step)
            part = row["part"][0].as_py()
            slots = (x.code & 1) * size + x.other_classes
            place = np.searchsorted(x.halo, x.words)
            place = np.where(np.append(x.halo, _END)[place] == x.words, 2 * (numbers + place), -1)
            self_ = np.bincount(x.word, np.where(x.code == place[x.word], x.n, 0), len(x.words))
            # Words whose turn it is not stay, and so do they if fewer of these moves are made.
            turns = moving(x.words, share, turn)
            to = x.classes.copy()
            # Words seen once, with equal classes around them, move alike: one of them is tried.
            ends = np.cumsum(np.bincount(x.word, minlength=len(x.words)))
            once = np.flatnonzero(turns & (np.bincount(x.word, x.n, len(x.words)) == 2))
            once = once[np.diff(ends, prepend=0)[once] == 2]
            around = (x.classes[once] * 2 * size + slots[ends[once] - 2]) * 2 * size + slots[ends[once] - 1]
            _, tried, alike = np.unique(around, return_index=True, return_inverse=True)
            turns[once] = False
            turns[once[tried]] = True
            movers, near = np.flatnonzero(turns), turns[x.word]
            word, slot, n = (np.cumsum(turns) - 1)[x.word[near]], slots[near], x.n[near]
            cuts = np.searchsorted(word, np.arange(0, len(movers) + _ROWS, _ROWS))
            steps = Steps.of(shipped.value, k)
            for i, (begin, end) in enumerate(itertools.pairwise(cuts)):
                here = movers[i * _ROWS : (i + 1) * _ROWS]
                own = x.classes[here]
                at = (word[begin:end] - i * _ROWS) * 2 * size + slot[begin:end]
                both = np.bincount(at, n[begin:end], len(own) * 2 * size).reshape(len(own), 2 * size)
                gain = gains(both[:, :size], both[:, size:], own, self_[here], shipped.value, k, steps)
                to[here] = _best(gain, own, k)
            to[once] = to[once[tried]][alike]
            out = [(part, -1, _pack(x.classes), _pack(to), int((x.classes != to).sum()))]
            # Every part that has a neighbour of a word here has the word in its halo.
            alone = np.flatnonzero(x.code >= 2 * numbers)
            asked = part_of(x.halo, parts)[(x.code[alone] >> 1) - numbers]
            sends = np.sort(asked * len(x.words) + x.word[alone])
            sends = sends[np.diff(sends, prepend=-1) > 0]
            cuts = np.searchsorted(sends, np.arange(parts + 1) * len(x.words))
            for p in np.flatnonzero(np.diff(cuts)):
                at = sends[cuts[p] : cuts[p + 1]] % len(x.words)
                out.append((p, part, _pack(x.classes[at]), _pack(to[at]), 0))
            return pa.table({c: pa.array(v, t) for c, v, t in zip(names, zip(*out), kinds)})

        proposed = grouped.applyInArrow(move, schema).checkpoint()
        gain = gains(sides[:, 0], sides[:, 1], first, np.diagonal(pairs).copy(), table, k)
        to = np.where(known & moving(hashes, share, turn), _best(gain, first, k), first)
        done = turn
        moved = (to != first).any() or proposed.agg(F.sum("moved")).first()[0]
        if not (open_ or moved):
            break
        moves = Moves(proposed, (first, to), share, turn)
    moves, first, table = kept
    step = moves.halvings, moves.turn

    def named(row: pa.Table, sent: pa.Table) -> pa.Table:
        if not row.num_rows:
            return pa.table({"word": pa.array([], pa.int64()), "class": pa.array([], pa.int32())})
        x = _part(row, sent, first, k, parts, step)
        return pa.table({"word": x.words, "class": pa.array(x.classes, pa.int32())})

    classes = (
        stored.groupBy("part").cogroup(moves.proposed.groupBy("part")).applyInArrow(named, "word long, class int")
    )
    firsts = spark.createDataFrame([*zip(words, first[:others].tolist())], "word long, class int")
    return classes.unionByName(firsts), table


def exchange(pairs: np.ndarray, count: int, settings: Settings) -> np.ndarray:
    """The class of every exchanged word, from the counts of pairs of symbols.

    Starts with words dealt by frequency. The classes of the other symbols stay. Every word in
    turn is taken out and put where the sum of n log n over pairs of classes, less twice that of
    the classes' own counts, is largest; ties go to the lowest class.
    """
    k = min(settings.classes, max(1, count))
    fixed = len(pairs) - count
    member = np.concatenate([np.arange(count) % k, k + np.arange(fixed)])
    size = k + fixed
    table = np.zeros((size, size))
    np.add.at(table, (member[:, None], member[None, :]), pairs)
    right = np.zeros((len(pairs), size))
    left = np.zeros((len(pairs), size))
    np.add.at(right.T, member, pairs.T)
    np.add.at(left.T, member, pairs)
    log = _log
    for _ in itertools.count() if settings.passes is None else range(settings.passes):
        moved = 0
        for w in range(count):
            own = member[w]
            after, before, self_ = right[w].copy(), left[w].copy(), pairs[w, w]
            after[own] -= self_
            before[own] -= self_
            # Without the word.
            table[own] -= right[w]
            table[:, own] -= left[w]
            table[own, own] += self_
            # Other words keep their pairs with this one.
            rows, columns = table.sum(axis=1) + before, table.sum(axis=0) + after
            t = table[:k]
            gain = log(t + after[None]).sum(axis=1) - log(t).sum(axis=1)
            c = table[:, :k]
            gain += log(c + before[:, None]).sum(axis=0) - log(c).sum(axis=0)
            d = np.arange(k)
            corner = table[d, d]
            gain += (
                log(corner + after[d] + before[d] + self_)
                - log(corner + after[d]) - log(corner + before[d]) + log(corner)
            )
            n_after, n_before = right[w].sum(), left[w].sum()
            gain -= log(rows[:k] + n_after) - log(rows[:k]) + log(columns[:k] + n_before) - log(columns[:k])
            best = int(np.argmax(gain >= gain.max() - 1e-9))
            if gain[own] >= gain[best] - 1e-9:
                best = own
            member[w] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += self_
            if best != own:
                moved += 1
                # Neighbours now see the word in its new class.
                right[:, own] -= pairs[:, w]
                right[:, best] += pairs[:, w]
                left[:, own] -= pairs[w]
                left[:, best] += pairs[w]
        if not moved:
            break
    return member


@dataclass(frozen=True)
class Model:
    """What tasks need, bounded by the numbers of classes and forms, and the table of classes."""

    classes: DataFrame | None  # word, class; stays out of tasks
    form_class: np.ndarray  # class of unseen words
    transition: np.ndarray  # log10, class before x class; the end is the last
    class_tokens: np.ndarray
    class_words: np.ndarray
    total: int  # training tokens, ends included
    ends: int
    distinct: int
    settings: Settings


def fit(texts: DataFrame, counts: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from texts (column `text`); `counts` is what `word_counts` gives, best stored."""
    spark = texts.sparkSession
    top = counts.orderBy(F.desc("n"), "word", "form").limit(settings.exchanged).collect()
    words = list(dict.fromkeys(r.word for r in top))
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total / (settings.chunk_bytes // 6)))
    rows = neighbours(texts, words, parts, settings)
    # The first words by number, then all others as one, then the end.
    count = len(words)
    # At most the square of the number of first words.
    found = (
        rows.select(F.explode(F.arrays_zip("at", "count")).alias("x"))
        .groupBy("x.at")
        .agg(F.sum("x.count").alias("n"))
        .toArrow()
    )
    first = np.zeros((count + 2, count + 2))
    first.reshape(-1)[found["at"].to_numpy()] = found["n"].to_numpy()
    member = exchange(first, count, settings)
    k = int(member[-1]) - 1
    named, table = exchange_all(rows, parts, words, first, member, k, settings)
    named = named.checkpoint()
    size = k + 1
    table = np.delete(np.delete(table, k, axis=0), k, axis=1)
    into = table.sum(axis=0)
    frequency = (into + 0.5) / (into.sum() + 0.5 * size)
    prior = settings.transition_prior
    transition = np.log10(
        (table + prior * frequency[None]) / (table.sum(axis=1, keepdims=True) + prior)
    )
    tokens_, distinct = np.zeros(size), np.zeros(size)
    of_form = np.zeros((_FORMS, k))
    for r in (
        counts.join(named, "word")
        .groupBy("class", "form")
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        .collect()
    ):
        tokens_[r["class"]] += r.n
        distinct[r["class"]] += r.words
        of_form[r.form, r["class"]] += r.words
    of_form[~of_form.any(axis=1)] = of_form.sum(axis=0)
    ends = int(into[-1])
    return Model(
        named, of_form.argmax(axis=1), transition, tokens_, distinct,
        int(tokens_.sum()) + ends, ends, int(distinct.sum()) + (ends > 0), settings,
    )


def score(rows: DataFrame, counts: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `rows`: doc_id, n_tokens, n_known, train_tokens, base_score, score and
    perplexity."""
    settings = model.settings
    chosen = rows.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = chosen.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    chunks = max(1, math.ceil(size / settings.chunk_bytes))
    chunk: Column = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("long")
    cut = chosen.withColumn("chunk", chunk).select("chunk", "doc_id", "text")
    shipped = rows.sparkSession.sparkContext.broadcast(replace(model, classes=None))

    def block_of(table: pa.Table) -> Block:
        return next(blocks(table["text"].chunks, sys.maxsize))

    def distinct_words(table: pa.Table) -> pa.Table:
        words = block_of(table).words
        number = table["chunk"][0].as_py()
        return pa.table({"chunk": np.full(len(words), number), "word": word_hashes(words)})

    wanted = cut.groupBy("chunk").applyInArrow(distinct_words, "chunk long, word long")
    learned = counts.select("word", "n").join(model.classes, "word")
    known = wanted.join(learned, "word").select("chunk", "word", "n", "class")

    def scored(key, table: pa.Table, counted: pa.Table) -> pa.Table:
        model: Model = shipped.value
        settings = model.settings
        block = block_of(table)
        hashes = word_hashes(block.words)
        n = np.zeros(len(hashes))
        member = model.form_class[forms(block.words)]
        if counted.num_rows and len(hashes):
            order = np.argsort(counted["word"].to_numpy())
            have = counted["word"].to_numpy()[order]
            at = np.minimum(np.searchsorted(have, hashes), len(have) - 1)
            same = have[at] == hashes
            n = np.where(same, counted["n"].to_numpy()[order][at], 0).astype(float)
            member = np.where(same, counted["class"].to_numpy()[order][at], member)
        prior = settings.emission_prior
        emission = np.log10(
            (n + prior) / (model.class_tokens[member] + prior * (model.class_words[member] + 1))
        )
        norm = model.total + 0.5 * (model.distinct + 1)
        base = np.log10((n + 0.5) / norm)
        end_base = math.log10((model.ends + 0.5) / norm)
        end = len(model.transition) - 1
        knowns, bases, scores = [], [], []
        stops = np.cumsum(block.lengths)
        for start, stop in zip((stops - block.lengths).tolist(), stops.tolist()):
            at = block.numbers[start:stop]
            classes = np.concatenate([[end], member[at], [end]])
            moves = model.transition[classes[:-1], classes[1:]].sum()
            knowns.append(int(np.count_nonzero(n[at])) + (model.ends > 0))
            bases.append(float(base[at].sum()) + end_base)
            scores.append(float(emission[at].sum() + moves))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n_tokens": pa.array(block.lengths + 1, pa.int64()),
                "n_known": pa.array(knowns, pa.int64()),
                "train_tokens": pa.array(np.full(len(stops), model.total), pa.int64()),
                "base_score": pa.array(bases, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    schema = (
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    found = cut.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(scored, schema)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
