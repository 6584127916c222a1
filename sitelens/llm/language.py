"""Languages of words and texts by a linear-chain conditional random field.

A word is a run of letters, a sequence the words of a line. Long lines are worked on in pieces of
`Settings.sequence` words; what the pieces before say about a piece's first word, and the pieces after
about its last, is carried over, so the cuts do not show. (In learning each piece is a line.)
A word's features are its character bigrams and trigrams with borders (so its first and last
letters too), its first and last four letters, and its entry in a lexicon of frequent words.
Forward-backward gives every word the probability of each language given its whole sequence, with
learned transitions, so a foreign phrase in a text is labelled as such. A text's language is the
one with the largest sum of these probabilities, weighted by letters.

Words are learned with the language of their text as label. A second round takes the labels that
the first model gives where words switch, so that transitions are learned from switches.

Sample bound: about `Settings.each` texts of every language (twice that in any case), chosen by a hash
among those of at most `Settings.longest` characters; longer ones are not learned from. Prediction reads
whole texts, and of a long one keeps no more than places and scores of its words.

Cases: a null text, or one without a letter, is `und` with score 0; ties go to the language that
sorts first; without any labelled text everything is `und`; equal texts have equal results.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import map_batches, remainder_is, sampled, texts

NO_LANGUAGE = "und"


@dataclass(frozen=True)
class Settings:
    each: int = 250
    longest: int = 20_000
    buckets: int = 1 << 17
    lexicon: int = 4000
    sequence: int = 64
    epochs: int = 4
    batch_words: int = 20_000
    rate: float = 0.3
    decay: float = 1e-6
    #: Probability of a switch with which the second round's labels are found.
    switch: float = 0.02
    #: Characters that are labelled at once, and that features are made of at once.
    block: int = 400_000
    section: int = 400_000


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # features x languages
    lexicon: np.ndarray  # sorted hashes of words; their weights follow those of the buckets
    start: np.ndarray  # log weights of the first word's language
    moves: np.ndarray  # log weights from language to language
    settings: Settings


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """The words of some texts, with the features of each as one flat list."""

    text: np.ndarray  # which text
    start: np.ndarray  # place in the joined code points
    length: np.ndarray
    sequence: np.ndarray  # which sequence
    place: np.ndarray  # place in the sequence
    features: np.ndarray
    first: np.ndarray  # where a word's features begin
    whole: np.ndarray  # hash of the word

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), np.diff(self.first, append=len(self.features)))


def words_of(lowered: list[str], buckets: int, lexicon: np.ndarray, longest: int) -> Words:
    """Find words and features of lower-case texts, all at once."""
    joined = "\n\n".join(lowered) + "\n\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    letter = _letters()[codes]
    edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    length = end - start
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    # A new line, and so a new text, starts a sequence; so does the place after a full one.
    line = np.searchsorted(np.flatnonzero(codes == 10), start)
    new = np.diff(line, prepend=-1) != 0
    if len(start):
        new[0] = True
    begins = np.flatnonzero(new)
    rank = np.arange(len(start)) - np.repeat(begins, np.diff(begins, append=len(start)))
    place = rank % longest
    sequence = np.cumsum(place == 0) - 1
    # Letters of words in a row, one border before each word and one after.
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(text, start, length, sequence, place, none, none, none)
    padded = length + 2
    at = np.cumsum(padded) - padded
    symbol = np.zeros(int(padded.sum()), np.uint64)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    symbol[np.repeat(at + 1, length) + inside] = codes[np.repeat(start, length) + inside]
    c1, c2, c3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    one, two = np.roll(symbol, -1), np.roll(symbol, -2)
    pair = symbol * c1 + one * c2
    # A word of n letters has n + 1 pairs and n triples; what starts at its last border has none.
    size = padded + padded - 3 + 3
    features = np.empty(int(size.sum()), np.int64)
    first = np.cumsum(size) - size
    spot = np.arange(len(symbol)) - np.repeat(at, padded)
    base = np.repeat(first, padded)
    room = np.repeat(padded, padded)
    mask = np.uint64(buckets - 1)
    bucket = lambda h, salt: (_mixed(h + np.uint64(salt)) & mask).astype(np.int64)
    keep = spot < room - 1
    features[base[keep] + spot[keep]] = bucket(pair[keep], 11)
    keep = spot < room - 2
    features[base[keep] + room[keep] - 1 + spot[keep]] = bucket(pair[keep] + two[keep] * c3, 23)
    last = first + size - 3
    ends = at + padded - 2
    four = lambda p, step: sum(
        (symbol[np.clip(p + step * i, at, at + padded - 1)] * c for i, c in enumerate((c1, c2, c3, c1 ^ c3))),
        np.zeros(len(p), np.uint64),
    )
    features[last] = bucket(four(at + 1, 1), 37)
    features[last + 1] = bucket(four(ends, -1), 41)
    # The whole word: letters weighted by powers, so that order counts.
    power = np.cumprod(np.full(int(padded.max()), c1, np.uint64))
    whole = _mixed(np.add.reduceat(_mixed(symbol + c2) * power[spot], at))
    found = np.searchsorted(lexicon, whole)
    known = found < len(lexicon)
    known[known] = lexicon[found[known]] == whole[known]
    # Words that the lexicon lacks share one feature without weight.
    features[last + 2] = np.where(known, buckets + 1 + found, buckets)
    return Words(text, start, length, sequence, place, features, first, whole)


def _grid(words: Words, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word scores as sequences x places x languages, and which of these there are."""
    count, steps = int(words.sequence[-1]) + 1, int(words.place.max()) + 1
    grid = np.zeros((count, steps, scores.shape[1]))
    there = np.zeros((count, steps), bool)
    grid[words.sequence, words.place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    there[words.sequence, words.place] = True
    return grid, there


@dataclass
class Borders:
    """What is known at the ends of sequences that are pieces of a line: which of them continue the
    one before, the state of that one's last word, and what follows says about the own last word."""

    continued: np.ndarray
    before: np.ndarray
    after: np.ndarray


def forward_backward(
    grid: np.ndarray,
    there: np.ndarray,
    start: np.ndarray,
    moves: np.ndarray,
    count_moves: bool,
    borders: Borders | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of every word's label and, for learning, expected numbers of moves.

    All sequences take a step together; those that have ended keep their state.
    """
    count, steps, k = grid.shape
    go = np.exp(moves - moves.max())
    ahead = np.zeros_like(grid)
    begin = np.tile(np.exp(start - start.max()), (count, 1))
    after = np.ones((count, k))
    if borders is not None:
        begin = np.where(borders.continued[:, None], borders.before @ go, begin)
        after = borders.after
    state = grid[:, 0] * begin
    ahead[:, 0] = state = state / state.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        step = (state @ go) * grid[:, t]
        step /= np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
        state = np.where(there[:, t, None], step, state)
        ahead[:, t] = state
    back = after
    found = np.zeros_like(grid)
    pairs = np.zeros((k, k))
    found[:, steps - 1] = ahead[:, steps - 1] * after
    for t in range(steps - 2, -1, -1):
        reach = grid[:, t + 1] * back
        here = there[:, t + 1]
        if count_moves:
            both = ahead[:, t, :, None] * go[None] * reach[:, None, :]
            total = np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)
            pairs += (both / total)[here].sum(axis=0)
        step = reach @ go.T
        step /= np.maximum(step.sum(axis=1, keepdims=True), 1e-300)
        back = np.where(here[:, None], step, after)
        found[:, t] = ahead[:, t] * back
    found /= np.maximum(found.sum(axis=2, keepdims=True), 1e-300)
    return found, pairs


def _operators(
    grid: np.ndarray, there: np.ndarray, start: np.ndarray, moves: np.ndarray, continued: np.ndarray
) -> np.ndarray:
    """What each sequence as a whole makes of a state: a matrix from the state before it (or from ones
    at the start of a line) to the state of its last word, up to a factor."""
    count, steps, k = grid.shape
    go = np.exp(moves - moves.max())
    first = np.where(continued[:, None, None], go, np.diag(np.exp(start - start.max())))
    out = first * grid[:, 0][:, None, :]
    out /= np.maximum(out.sum(axis=(1, 2), keepdims=True), 1e-300)
    for t in range(1, steps):
        step = (out @ go) * grid[:, t][:, None, :]
        step /= np.maximum(step.sum(axis=(1, 2), keepdims=True), 1e-300)
        out = np.where(there[:, t, None, None], step, out)
    return out


#: Sequences that are worked on at once.
_TOGETHER = 2048


def chain_posterior(
    scores: np.ndarray, new_line: np.ndarray, longest: int, start: np.ndarray, moves: np.ndarray
) -> np.ndarray:
    """Probabilities of every word's label given its whole line, from scores of words in a row.

    Lines are cut into sequences of `longest` words. First every sequence of a cut line becomes a
    matrix; walking along the line with these gives the states at its cuts, both ways; then all
    sequences are worked out between their borders.
    """
    n, k = scores.shape
    begins = np.flatnonzero(new_line)
    rank = np.arange(n) - np.repeat(begins, np.diff(begins, append=n))
    place = rank % longest
    firsts = np.flatnonzero(place == 0)
    continued = rank[firsts] > 0
    count = len(firsts)
    ends = np.append(firsts[1:], n)
    borders = Borders(continued, np.ones((count, k)), np.ones((count, k)))

    def grid_of(low: int, high: int) -> tuple[np.ndarray, np.ndarray, slice]:
        words = slice(firsts[low], ends[high - 1])
        sequence = np.repeat(np.arange(high - low), ends[low:high] - firsts[low:high])
        steps = int((ends[low:high] - firsts[low:high]).max())
        grid, there = np.zeros((high - low, steps, k)), np.zeros((high - low, steps), bool)
        own = scores[words]
        grid[sequence, place[words]] = np.exp(own - own.max(axis=1, keepdims=True))
        there[sequence, place[words]] = True
        return grid, there, words

    slices = [(low, min(count, low + _TOGETHER)) for low in range(0, count, _TOGETHER)]
    if continued.any():
        cut = continued | np.append(continued[1:], False)
        matrices = np.zeros((count, k, k))
        for low, high in slices:
            own = np.flatnonzero(cut[low:high])
            if len(own):
                grid, there, _ = grid_of(low, high)
                matrices[low + own] = _operators(
                    grid[own], there[own], start, moves, continued[low + own]
                )
        pieces = np.flatnonzero(continued)
        for c in pieces:
            state = borders.before[c - 1] @ matrices[c - 1]
            borders.before[c] = state / max(state.sum(), 1e-300)
        for c in pieces[::-1]:
            said = matrices[c] @ borders.after[c]
            borders.after[c - 1] = said / max(said.sum(), 1e-300)
    out = np.zeros((n, k))
    for low, high in slices:
        grid, there, words = grid_of(low, high)
        own = Borders(continued[low:high], borders.before[low:high], borders.after[low:high])
        found, _ = forward_backward(grid, there, start, moves, False, own)
        out[words] = found[there]
    return out


def _scores(words: Words, weights: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights[words.features], words.first, axis=0)


def _posterior(
    words: Words, weights: np.ndarray, start: np.ndarray, moves: np.ndarray, count_moves: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    grid, there = _grid(words, _scores(words, weights))
    found, pairs = forward_backward(grid, there, start, moves, count_moves)
    return found[words.sequence, words.place], pairs


def _blocks(values: list[str], limit: int) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of bounded size; a long text is a group of its own."""
    first, group, size = 0, [], 0
    for i, value in enumerate(values):
        if group and size + len(value) > limit:
            yield first, group
            first, group, size = i, [], 0
        group.append(value)
        size += len(value)
    if group:
        yield first, group


def train(samples: list[tuple[str, str]], settings: Settings = Settings()) -> Model:
    """Learn from (language, text)."""
    languages = tuple(sorted({language for language, _ in samples}))
    k = len(languages)
    samples = sorted(samples, key=lambda s: (hash_text(s[1]), s[0]))
    lowered = [t.lower() for _, t in samples]
    label = np.array([languages.index(language) for language, _ in samples], np.int64)
    everything = words_of(lowered, settings.buckets, np.zeros(0, np.uint64), settings.sequence)
    if not len(everything.start):
        return Model((), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, 0)), settings)
    names, counts = np.unique(everything.whole, return_counts=True)
    frequent = np.lexsort((names, -counts))[: settings.lexicon]
    lexicon = np.sort(names[frequent])
    weights = np.zeros((settings.buckets + 1 + len(lexicon), k))
    squares = np.full_like(weights, 1e-8)
    start, moves = np.zeros(k), np.zeros((k, k))
    move_squares, start_squares = np.full((k, k), 1e-8), np.full(k, 1e-8)
    groups = []
    for first, group in _blocks(lowered, settings.batch_words * 6):
        words = words_of(group, settings.buckets, lexicon, settings.sequence)
        if len(words.start):
            groups.append([words, label[first + words.text]])
    for round_ in range(2):
        for _ in range(settings.epochs):
            for words, truth in groups:
                found, pairs = _posterior(words, weights, start, moves, True)
                error = found
                error[np.arange(len(truth)), truth] -= 1.0
                owner = words.owner
                for j in range(k):
                    g = np.bincount(
                        words.features, weights=error[owner, j], minlength=len(weights)
                    ) + settings.decay * weights[:, j]
                    g[settings.buckets] = 0.0
                    squares[:, j] += g * g
                    weights[:, j] -= settings.rate * g / np.sqrt(squares[:, j])
                inner = np.flatnonzero(words.place[1:] > 0) + 1
                seen = np.zeros((k, k))
                np.add.at(seen, (truth[inner - 1], truth[inner]), 1.0)
                g = pairs - seen
                move_squares += g * g
                moves -= settings.rate * g / np.sqrt(move_squares)
                begins = words.place == 0
                g = error[begins].sum(axis=0)
                start_squares += g * g
                start -= settings.rate * g / np.sqrt(start_squares)
        if round_ == 0 and k > 1:
            calm = np.full((k, k), np.log(settings.switch / (k - 1)))
            np.fill_diagonal(calm, np.log(1 - settings.switch))
            for group in groups:
                found, _ = _posterior(group[0], weights, np.zeros(k), calm)
                sure = found.max(axis=1) > 0.9
                group[1] = np.where(sure, found.argmax(axis=1), group[1])
    return Model(languages, weights.astype(np.float32), lexicon, start, moves, settings)


def hash_text(text: str) -> int:
    """An order of texts that has nothing to do with their language."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


@dataclass
class Labelled:
    language: str
    score: float
    letters: int
    words: int
    switched: int
    runs: list[tuple[int, int, str]]


@dataclass
class Found:
    """The words of some texts without their features."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    new_line: np.ndarray
    scores: np.ndarray


def _found_words(lowered: list[str], model: Model) -> Found | None:
    """Words of lower-case texts and their scores, section by section; None without any."""
    joined = "\n\n".join(lowered) + "\n\n"
    starts, lengths, scores, breaks = [], [], [], []
    for offset, part in _sections(joined, model.settings.section):
        words = words_of([part], model.settings.buckets, model.lexicon, model.settings.sequence)
        if len(words.start):
            starts.append(words.start + offset)
            lengths.append(words.length)
            scores.append(_scores(words, model.weights))
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        breaks.append(np.flatnonzero(codes == 10) + offset)
    if not starts:
        return None
    start = np.concatenate(starts)
    line = np.searchsorted(np.concatenate(breaks), start)
    new_line = np.diff(line, prepend=-1) != 0
    new_line[0] = True
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    return Found(text, start, np.concatenate(lengths), new_line, np.concatenate(scores))


def _sections(joined: str, size: int) -> Iterator[tuple[int, str]]:
    """A text in parts that end before a character that is no letter, with where they begin."""
    begin = 0
    while begin < len(joined):
        end = min(len(joined), begin + size)
        while end < len(joined) and joined[end].isalpha():
            end += 1
        yield begin, joined[begin:end]
        begin = end


def label(model: Model, values: list[str], runs: bool = False) -> list[Labelled]:
    """The languages of texts; with `runs` also where words of one language follow each other."""
    out: list[Labelled] = []
    k = len(model.languages)
    for _, group in _blocks(values, model.settings.block):
        words = _found_words([lower(t) for t in group], model) if k else None
        if words is None:
            out += [Labelled(NO_LANGUAGE, 0.0, 0, 0, 0, []) for _ in group]
            continue
        found = chain_posterior(
            words.scores, words.new_line, model.settings.sequence, model.start, model.moves
        )
        n = len(group)
        votes = np.stack(
            [np.bincount(words.text, weights=found[:, j] * words.length, minlength=n) for j in range(k)], 1
        )
        letters = np.bincount(words.text, weights=words.length, minlength=n)
        count = np.bincount(words.text, minlength=n)
        best = votes.argmax(axis=1)
        own = found.argmax(axis=1)
        other = np.bincount(words.text, weights=own != best[words.text], minlength=n)
        offset = np.cumsum([0, *[len(t) + 2 for t in group]])
        begin = np.searchsorted(words.text, np.arange(n + 1))
        for i in range(n):
            if not count[i]:
                out.append(Labelled(NO_LANGUAGE, 0.0, 0, 0, 0, []))
                continue
            pieces: list[tuple[int, int, str]] = []
            if runs:
                for w in range(begin[i], begin[i + 1]):
                    s = int(words.start[w] - offset[i])
                    e, name = s + int(words.length[w]), model.languages[own[w]]
                    if pieces and pieces[-1][2] == name:
                        pieces[-1] = (pieces[-1][0], e, name)
                    else:
                        pieces.append((s, e, name))
            score = float(min(1.0, max(0.0, votes[i, best[i]] / letters[i])))
            out.append(
                Labelled(model.languages[best[i]], score, int(letters[i]), int(count[i]), int(other[i]), pieces)
            )
    return out


def lower(text: str) -> str:
    """Lower case that keeps the number of characters, so that places stay."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else "".join(
        low if len(low := c.lower()) == 1 else c for c in text
    )


def fit(
    docs: DataFrame,
    settings: Settings = Settings(),
    *,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    held_out: tuple[int, int] = (4, 2),
) -> Model:
    """Learn from texts with a language that are not held out (crc32 of the id, as (modulus, remainder))."""
    usable = docs.select(
        F.col(id).cast("long").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).filter(
        F.col("lang").isNotNull()
        & ~remainder_is(F.col("id"), *held_out)
        & (F.length("text") <= settings.longest)
    )
    rows = sampled(usable, "id", "lang", settings.each).collect()
    return train([(r.lang, r.text) for r in rows], settings)


def predict(
    rows: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", runs: bool = False
) -> DataFrame:
    """The language of every text: doc_id, lang_pred, score, n_words, n_switched and, if asked
    for, runs of words with their language (start, end, lang; code points)."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = label(shipped.value, texts(batch.column(1)), runs)
        columns = [
            batch.column(0),
            pa.array([f.language for f in found], pa.string()),
            pa.array([f.score for f in found], pa.float64()),
            pa.array([f.words for f in found], pa.int64()),
            pa.array([f.switched for f in found], pa.int64()),
        ]
        names = ["doc_id", "lang_pred", "score", "n_words", "n_switched"]
        if runs:
            pieces = [[{"start": s, "end": e, "lang": x} for s, e, x in f.runs] for f in found]
            columns.append(pa.array(pieces, run_type))
            names.append("runs")
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, lang_pred string, score double, n_words long, n_switched long"
    if runs:
        schema += ", runs array<struct<start:int,end:int,lang:string>>"
    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, apply, schema)
