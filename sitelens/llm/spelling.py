"""Grouping spelling variants by composing finite-state machines.

Two words are near if one edit (a letter inserted, deleted or replaced) turns one into the other. With
V the minimised acyclic acceptor of a vocabulary and E the transducer of exactly one edit, the near
pairs are what V o E o V accepts. Every word then follows its most frequent near word, if that is
frequent enough, to a root.

One machine for a whole vocabulary would have to fit one task, so pairs are enumerated per initial-state
partition. The edit of a pair lies at one place, the end of its common beginning. If that place is in an
interval [a, b), both words agree on the a letters before it and on the letters after it: for shorter
words of length s these are the letters from b on. Words that agree on both form a block, whose machine
starts in the state that the common beginning leads to and whose final state is where the common end
begins. The two halves of a word are its first intervals, so a word is in at most four blocks (as one
of the shorter and of the longer words, for the edit in either half). A block that is too large is
split: each half of its interval makes blocks of its own that agree on more letters. At the end of that
road is an interval of one place, where a block holds no more words than there are pairs of letters. No
block is cut short, and every pair is found in exactly one block.

The words of a block meet in a task as a run of sorted rows. What leaves it is a count and a best
partner per word and block, so frequent words with many partners are summed where they are found.

Cases: a null or empty text has no words; a null id counts as an empty one; equal rows count as often
as they occur; of partners with equal counts the first in code-point order is the best; a vocabulary
without near words, or an empty table, has no pairs, and words without a form are their own roots.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of a word as the inside of a regular expression class.
LETTERS = "A-Za-zÀ-ÿ"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    least_length: int = 5
    least_count: int = 3
    #: A form is at least so many times as frequent as the word that follows it.
    times: int = 2
    #: A block is split if its words have more letters than this in its interval, all together ...
    letters: int = 200_000
    #: ... or if its interval is longer than this.
    width: int = 64


def occurrences(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    slip: int | None = None,
    least_length: int = 1,
) -> DataFrame:
    """One row per word of every text that is long enough: column word.

    With `slip`, a word is taken as misspelt where that number divides the crc32 of
    "<id>:<word>": it loses the letter at the remainder of the crc32 by its length.
    """
    long_runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    rows = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
        F.explode(long_runs).alias("word"),
    )
    capital = F.col("word").rlike("[A-Z]")
    lowered = F.when(capital, F.translate("word", UPPER, LOWER)).otherwise(F.col("word"))
    runs = rows.select("id", lowered.alias("word"))
    if slip is None:
        return runs.select("word")
    hashed = runs.withColumn("hash", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
    place = (F.col("hash") % F.length("word")).cast("int")
    shorter = F.concat(
        F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word"))
    )
    return hashed.select(
        F.when(F.col("hash") % slip == 0, shorter).otherwise(F.col("word")).alias("word")
    )


def vocabulary(occurrences: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Words that are long and frequent enough: word, n."""
    return (
        occurrences.filter(F.length("word") >= settings.least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= settings.least_count)
    )


# A block's members share `size` (the length s of its shorter words), the interval [low, high) and the
# letters outside it; `key` is a hash of all that.


def _keyed(rows: DataFrame) -> DataFrame:
    # Of the last interval, high is s + 1: it has the place after the last letter, and no end.
    end = F.greatest(F.col("size") - F.col("high"), F.lit(0))
    begin = F.substring("word", F.lit(1), F.col("low"))
    rest = F.when(end > 0, F.substring("word", F.length("word") - end + 1, end)).otherwise("")
    return rows.withColumn("key", F.xxhash64("size", "low", "high", begin, rest))


def _halves(rows: DataFrame) -> DataFrame:
    """Both halves of an interval, as blocks of their own."""
    middle = F.expr("(low + high) div 2").cast("int")
    parts = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    split = rows.withColumn("part", F.explode(parts))
    return _keyed(split.select("word", "n", "size", "part.low", "part.high"))


def blocks(vocabulary: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every word once for each block that it belongs to: word, n, size, low, high, key."""
    length = F.length("word")
    # A word is one of the shorter words of its blocks, or one of the longer.
    sizes = F.array(length, length - 1)
    rows = vocabulary.select("word", "n", F.explode(sizes).alias("size"))
    rows = rows.filter(F.col("size") >= settings.least_length)
    whole = rows.select("word", "n", "size", F.lit(0).alias("low"), (F.col("size") + 1).alias("high"))
    todo, done = _halves(whole), None
    while True:
        width = F.col("high") - F.col("low")
        large = (
            todo.groupBy("key")
            .agg(F.count("*").alias("words"), F.max(width).alias("width"))
            .filter(
                (F.col("words") > 1)
                & (F.col("width") > 1)
                & ((F.col("words") * F.col("width") > settings.letters) | (F.col("width") > settings.width))
            )
            .select("key")
            .checkpoint()
        )
        if large.isEmpty():
            return todo if done is None else done.unionByName(todo)
        small = todo.join(large, "key", "leftanti")
        done = small if done is None else done.unionByName(small)
        todo = _halves(todo.join(large, "key", "leftsemi")).checkpoint()


class Acceptor:
    """The minimal acyclic automaton of sorted words.

    Words come in order, so the states of the last word are final as soon as the next one leaves
    its path, and equal ones become one.
    """

    def __init__(self, words: Sequence[str]):
        self.next: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._register: dict[tuple, int] = {}
        path, last = [0], ""
        for word in words:
            shared = 0
            for x, y in zip(word, last, strict=False):
                if x != y:
                    break
                shared += 1
            self._merge(path, last, shared)
            for letter in word[shared:]:
                self.next.append({})
                self.final.append(False)
                self.next[path[-1]][letter] = len(self.next) - 1
                path.append(len(self.next) - 1)
            self.final[path[-1]] = True
            last = word
        self._merge(path, last, 0)

    def _merge(self, path: list[int], word: str, length: int) -> None:
        """Replace the states of the path beyond a length by equal ones that are known."""
        while len(path) > length + 1:
            state = path.pop()
            alike = (self.final[state], *self.next[state].items())
            known = self._register.setdefault(alike, state)
            if known != state:
                self.next[path[-1]][word[len(path) - 1]] = known


class Composition:
    """What `left` o one edit o `right` accepts: pairs that differ by one letter replaced (if both
    are the same acceptor) or one inserted on the right.

    A state of the composition is a pair of states and whether the edit has been made; what can be
    read from it is worked out once.
    """

    def __init__(self, left: Acceptor, right: Acceptor):
        self.left, self.right = left, right
        self._both: dict[tuple[int, int], tuple[str, ...]] = {}
        self._replaced: dict[int, list[tuple[str, str]]] = {}
        self._inserted: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def both(self, p: int, q: int) -> tuple[str, ...]:
        """After the edit: what is accepted from both states."""
        found = self._both.get((p, q))
        if found is None:
            out = [""] if self.left.final[p] and self.right.final[q] else []
            after = self.right.next[q]
            for letter, state in self.left.next[p].items():
                other = after.get(letter)
                if other is not None:
                    out += [letter + x for x in self.both(state, other)]
            found = self._both[p, q] = tuple(out)
        return found

    def replaced(self, p: int = 0) -> list[tuple[str, str]]:
        """Before the edit, for an acceptor with itself: pairs with one letter replaced, the smaller
        letter on the left."""
        found = self._replaced.get(p)
        if found is None:
            found = []
            steps = self.left.next[p].items()
            for (x, after_x), (y, after_y) in itertools.combinations(steps, 2):
                found += [(x + rest, y + rest) for rest in self.both(after_x, after_y)]
            for letter, state in steps:
                found += [(letter + x, letter + y) for x, y in self.replaced(state)]
            self._replaced[p] = found
        return found

    def inserted(self, p: int = 0, q: int = 0) -> list[tuple[str, str]]:
        """Before the edit: pairs with one letter inserted on the right. Of the places that give
        the same pair (in a run of a letter) it is the last, where the words first differ."""
        found = self._inserted.get((p, q))
        if found is None:
            found = []
            after = self.right.next[q]
            for letter, state in after.items():
                found += [(x, letter + x) for x in self.both(p, state) if x[:1] != letter]
            for letter, state in self.left.next[p].items():
                other = after.get(letter)
                if other is not None:
                    found += [(letter + x, letter + y) for x, y in self.inserted(state, other)]
            self._inserted[p, q] = found
        return found


def near_in_block(words: Sequence[str], size: int, low: int, high: int) -> Iterator[tuple[str, str]]:
    """The near pairs of a block whose edit lies in its interval, each once, the shorter word first."""
    end = max(size - high, 0)
    inside = {w[low : len(w) - end]: w for w in words}
    width = min(high, size) - low
    short = sorted(x for x in inside if len(x) == width)
    if not short:
        return
    long = sorted(x for x in inside if len(x) == width + 1)
    acceptor = Acceptor(short)
    if len(short) > 1:
        for x, y in Composition(acceptor, acceptor).replaced():
            yield inside[x], inside[y]
    if long:
        for x, y in Composition(acceptor, Acceptor(long)).inserted():
            # At the end of the interval the edit belongs to the next one, if there is one.
            if high > size or y[:width] != x:
                yield inside[x], inside[y]


class _Partners:
    """Counts and best partners of the words of one task, handed on in batches."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.count: dict[str, int] = {}
        self.best: dict[str, tuple[int, str]] = {}

    def add(self, word: str, other: str, n: int) -> None:
        self.count[word] = self.count.get(word, 0) + 1
        rank = (-n, other)
        if word not in self.best or rank < self.best[word]:
            self.best[word] = rank

    def batch(self) -> pa.RecordBatch:
        best = list(self.best.values())
        columns = [
            pa.array(self.count.keys(), pa.string()),
            pa.array(self.count.values(), pa.int64()),
            pa.array([-n for n, _ in best], pa.int64()),
            pa.array([w for _, w in best], pa.string()),
        ]
        # Words come into both tables together, so both have the same order.
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


#: Words after which a task hands on what it has counted.
_HELD = 50_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with equal keys that follow each other, across batches."""
    run: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if run and row[0] != run[0][0]:
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def partners(blocks: DataFrame) -> DataFrame:
    """Of every word that has near words in some block: word, n_near, best_n, best. A word has a
    row for each task in which some were found."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Partners()
        for run in _runs(batches):
            if len(run) == 1:
                continue
            # Words whose keys are equal by chance are told apart here.
            groups: dict[tuple, dict[str, int]] = {}
            for _, word, n, size, low, high in run:
                end = max(size - high, 0)
                alike = (size, low, high, word[:low], word[len(word) - end :])
                groups.setdefault(alike, {})[word] = n
            for (size, low, high, *_), counts in groups.items():
                if len(counts) > 1:
                    for x, y in near_in_block(list(counts), size, low, high):
                        found.add(x, y, counts[y])
                        found.add(y, x, counts[x])
            if len(found.count) >= _HELD:
                yield found.batch()
                found.clear()
        if found.count:
            yield found.batch()

    rows = blocks.select("key", "word", "n", "size", "low", "high")
    met = rows.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(apply, "word string, n_near long, best_n long, best string")


def roots(links: DataFrame) -> DataFrame:
    """The end of the chain of every word that has a form: word, root.

    `links` has a row (word, form) for each such word, without circles. Each round doubles the
    steps that have been followed, until none is left.
    """
    now = links.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = now.join(step, "root", "left")
        now = longer.select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ).checkpoint()
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(vocabulary: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every word of a vocabulary (word, n) with its form and root: word, form, root, n, n_near,
    form_n.

    The form is the near word of largest n, if that is at least `times` the word's own, else null.
    """
    words = vocabulary.select("word", "n").checkpoint()
    found = (
        partners(blocks(words, settings))
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("first"),
        )
    )
    frequent = -F.col("first.minus") >= settings.times * F.col("n")
    judged = (
        words.join(found, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("first.best")).alias("form"),
            F.when(frequent, -F.col("first.minus")).alias("form_n"),
        )
        .checkpoint()
    )
    ends = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
