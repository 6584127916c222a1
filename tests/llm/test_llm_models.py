"""Classifier, language and language model: held-out accuracy and plain references."""

import itertools
import math
from collections import Counter
from dataclasses import replace

import cases
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitelens.llm import brown_lm, language, quality_classifier
from sitelens.llm.common import documents, remainder_is, sampled

FOLDER = "/root/testdata/sf0.01"


def test_classifier_separates_held_out_labels(ready):
    docs, labels = documents(ready, FOLDER), ready.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    scored = quality_classifier.score(docs, model).join(labels, "doc_id")
    rows = scored.filter(remainder_is(F.col("doc_id"), 5, 0)).collect()
    assert len(rows) > 50
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in rows) / len(rows) >= 0.95
    kept = quality_classifier.accepted(docs, model)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality_classifier.score(docs, model).filter("score >= 0.3").collect()}
    assert {r.doc_id for r in kept.collect()} == ids


def test_classifier_cases(ready):
    docs = cases.frame(ready)
    none = ready.createDataFrame([(1, None), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, none)
    assert model.curve is None
    assert {r.score for r in quality_classifier.score(docs, model).collect()} == {1.0}
    some = ready.createDataFrame(
        [(i, 1 if i < 200 else 0) for i in range(400)], "doc_id long, quality int"
    )
    taught = cases.frame(
        ready,
        [(i, cases.prose(i, 80) if i < 200 else "$$$ %%% " * 50 + str(i), "en", "a") for i in range(400)],
    )
    model = quality_classifier.fit(taught, some)
    found = quality_classifier.score(docs, model).collect()
    assert len(found) == len(cases.texts()) and all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (4, 5)}
    assert len(empty) == 1
    assert len({r.score for r in found if r.doc_id == 12}) == 1
    score = {r.doc_id: r.score for r in found}
    assert score[1] > 0.9 > 0.5 > score[14]
    assert quality_classifier.score(cases.empty(ready), model).collect() == []
    assert quality_classifier.accepted(cases.empty(ready), model).collect() == []


def test_sample_is_bounded_and_repeatable(ready):
    rows = ready.range(20_000).select("id", (F.col("id") % 3).alias("kind"))
    ids = [sorted(r.id for r in sampled(rows, "id", "kind", 100).collect()) for _ in range(2)]
    assert ids[0] == ids[1] and 150 < len(ids[0]) <= 600


def test_language_on_held_out_documents(ready):
    docs = documents(ready, FOLDER)
    model = language.fit(docs, language.Settings(each=100))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter(remainder_is(F.col("doc_id"), 4, 2)).collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def two_languages():
    r = cases.rng(3)
    word = lambda parts: "".join(r.choices(parts, k=r.randint(1, 3)))
    english, french = "the ing er th ed wh".split(), "eau é ou que ç ille".split()
    samples = [("en", " ".join(word(english) for _ in range(60))) for _ in range(60)]
    samples += [("fr", " ".join(word(french) for _ in range(60))) for _ in range(60)]
    return language.train(samples, language.Settings(buckets=1 << 12, lexicon=100))


def test_switched_words_are_labelled(two_languages):
    found = language.label(two_languages, ["thewher therwhed eau oueau quequeé thering edwh"], runs=True)[0]
    assert [name for *_, name in found.runs] == ["en", "fr", "en"]
    assert found.language == "en" and found.switched == 3


def test_forward_backward_is_the_sum_over_all_labellings():
    r = np.random.RandomState(0)
    scores, start, moves = r.randn(4, 3), r.randn(3), r.randn(3, 3)
    total = np.zeros((4, 3))
    for labels in np.ndindex(3, 3, 3, 3):
        weight = start[labels[0]] + sum(scores[i, k] for i, k in enumerate(labels))
        weight += sum(moves[a, b] for a, b in zip(labels, labels[1:]))
        for i, k in enumerate(labels):
            total[i, k] += math.exp(weight)
    grid = np.zeros((2, 5, 3))
    there = np.zeros((2, 5), bool)
    grid[0, :4], there[0, :4] = np.exp(scores), True
    grid[1, :5], there[1] = 1.0, True
    found, _ = language.forward_backward(grid, there, start, moves, False)
    assert np.allclose(found[0, :4], total / total.sum(axis=1, keepdims=True))


def test_language_cases(ready, two_languages):
    found = language.predict(cases.frame(ready), two_languages, runs=True).collect()
    assert len(found) == len(cases.texts())
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for i in (4, 5, 6, 14):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[7].n_words > 29_000 and by[8].n_words == 1
    assert language.predict(cases.empty(ready), two_languages).collect() == []
    nothing = language.fit(cases.empty(ready))
    assert {r.lang_pred for r in language.predict(cases.frame(ready), nothing).collect()} == {"und"}


def plain_base(rows):
    learned = Counter()
    for i, t, *_ in rows:
        if cases.crc(i, 5) != 1:
            learned.update(w.lower() for w in cases.words(t))
            learned[None] += 1
    total, distinct = sum(learned.values()), len(learned)
    out = []
    for i, t, *_ in rows:
        tokens = [*(w.lower() for w in cases.words(t)), None]
        score = sum(math.log10((learned[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        out.append((str(i), len(tokens), sum(learned[w] > 0 for w in tokens), total, round(score, 6)))
    return sorted(out)


def scored(ready, docs, settings):
    known = docs.filter(~remainder_is(F.col("doc_id"), 5, 1)).select("text")
    counts = brown_lm.word_counts(known, settings).checkpoint()
    model = brown_lm.fit(known, counts, settings)
    return model, brown_lm.score(docs, counts, model).collect()


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 3000])
def test_language_model_base_is_the_plain_sum(ready, chunk_bytes):
    settings = brown_lm.Settings(exchanged=50, classes=6, chunk_bytes=chunk_bytes)
    _, found = scored(ready, cases.frame(ready), settings)
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]
    assert sorted(got) == plain_base(cases.texts())
    assert all(r.score <= 0 for r in found)


def test_language_model_without_texts(ready):
    _, found = scored(ready, cases.empty(ready), brown_lm.Settings())
    assert found == []
    only = cases.frame(ready, [(i, "a b", "en", "s") for i in range(30) if cases.crc(i, 5) == 1])
    _, found = scored(ready, only, brown_lm.Settings())
    assert found and all(r.base_score == 0.0 and r.n_known == 0 for r in found)


def test_language_model_is_a_distribution_and_beats_the_base(ready):
    docs = documents(ready, FOLDER)
    model, found = scored(ready, docs, brown_lm.Settings(exchanged=300, classes=20, passes=3))
    assert np.allclose((10**model.transition).sum(axis=1), 1.0)
    held = [r for r in found if cases.crc(r.doc_id, 5) == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_raises_mutual_information():
    r = np.random.RandomState(1)
    count, fixed = 30, brown_lm._FORMS + 1
    pairs = np.zeros((count + fixed, count + fixed))
    for a in range(count):
        for b in range(count):
            pairs[a, b] = r.poisson(30 if a % 3 == (b + 1) % 3 else 1)
    settings = brown_lm.Settings(classes=3)

    def worth(member):
        table = np.zeros((3, 3))
        np.add.at(table, (member[:count, None], member[None, :count]), pairs[:count, :count])
        p = table / table.sum()
        return (p * np.log(p / np.outer(p.sum(1), p.sum(0)))).sum()

    mixed = pairs[np.ix_(order := [*r.permutation(count), *range(count, count + fixed)], order)]
    member = brown_lm.exchange(mixed, count, settings)
    groups = {tuple(sorted({order[i] % 3 for i in range(count) if member[i] == k})) for k in range(3)}
    assert groups == {(0,), (1,), (2,)}
    pairs = mixed
    assert worth(member) > worth(np.concatenate([np.arange(count) % 3, np.arange(fixed) + 3]))


def test_every_training_word_is_clustered(ready):
    r = cases.rng(4)
    groups = [[f"{g}{i}" for i in range(160)] for g in "ab"]
    often = [30] * 10 + [1] * 150
    line = lambda: " ".join(w for _ in range(40) for w in (r.choices(g, often)[0] for g in groups))
    docs = cases.frame(ready, [(i, line(), "en", "s") for i in range(300)])
    known = docs.select("text")
    settings = brown_lm.Settings(exchanged=20, classes=2)
    counts = brown_lm.word_counts(known, settings).checkpoint()
    model = brown_lm.fit(known, counts, settings)
    assert model.class_words.sum() == 320 and model.class_words[:2].tolist() == [160, 160]
    named = {x.word: x["class"] for x in model.classes.collect()}
    of = lambda words: {named[h] for h in brown_lm.word_hashes([w.encode() for w in words]).tolist()}
    assert len(of(groups[0])) == len(of(groups[1])) == 1 and of(groups[0]) != of(groups[1])


def test_passes_shuffle_classes_only_and_neighbours_are_whole(ready):
    r = cases.rng(5)
    texts = [" ".join(r.choice("abcdefghij") * r.randint(1, 4) for _ in range(r.randint(0, 30))) for _ in range(60)]
    docs = cases.frame(ready, [(i, t, "en", "s") for i, t in enumerate([*texts, "x x x"])]).select("text")
    plain = Counter()
    for t in [*texts, "x x x"]:
        line = [None, *t.split(), None]
        plain.update(zip(line, line[1:]))
    hashes = {w: int(brown_lm.word_hashes([w.encode()])[0]) for pair in plain for w in pair if w}
    first = [hashes["a"], hashes["bb"]]
    settings = brown_lm.Settings(chunk_bytes=2000)
    rows = brown_lm.neighbours(docs, first, 3, settings)
    number = {None: 3} | {w: first.index(h) if h in first else 2 for w, h in hashes.items()}
    found, at = Counter(), Counter()
    for row in rows.collect():
        words, halo, degree, code, n = (
            brown_lm._unpack(pa.scalar(bytes(row[c]))).tolist() for c in ("words", "halo", "degree", "code", "n")
        )
        at.update(dict(zip(row["at"], row["count"])))
        for word, c, k in zip(np.repeat(words, degree).tolist(), code, n):
            other = c // 2 if c < 8 else halo[c // 2 - 4]
            found[(other, word) if c % 2 else (word, other)] += k
    name = lambda w: hashes[w] if number[w] == 2 else number[w]
    twice = Counter()
    for (a, b), k in plain.items():
        twice[name(a), name(b)] += k * ((number[a] == 2) + (number[b] == 2))
    assert found == +twice
    pairs = Counter()
    for (a, b), k in plain.items():
        pairs[number[a] * 4 + number[b]] += k
    assert at == pairs
    sent = ready.createDataFrame([(0, 1)], "part long, source long")
    passed = rows.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(lambda x, y: x, rows.schema)
    passed.collect()
    plan = passed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_words_move_in_turns_as_spark_hashes_them(ready):
    words = np.array([0, 1, -1, brown_lm._END, *range(10**15, 10**15 + 400)], np.int64)
    rows = ready.createDataFrame([(int(w),) for w in words], "word long")
    for halvings, turn in ((0, 0), (1, 1), (2, 7), (5, 12)):
        share = F.pmod(F.xxhash64("word", F.lit(turn)), F.lit(1 << halvings)) == 0
        want = {r.word for r in rows.filter(share).collect()}
        assert set(words[brown_lm.moving(words, halvings, turn)].tolist()) == want


def test_gains_are_the_change_of_information():
    r = np.random.RandomState(2)
    pairs = r.poisson(0.7, (14, 14)).astype(float) * r.randint(1, 30, (14, 14))
    member = np.concatenate([np.arange(12) % 4, [4, 5]])  # three classes, one to leave, two fixed

    def table(member):
        found = np.zeros((6, 6))
        np.add.at(found, (member[:, None], member[None]), pairs)
        return found

    sides = np.zeros((2, 12, 6))
    for w in range(12):
        np.add.at(sides[0, w], member, pairs[w])
        np.add.at(sides[1, w], member, pairs[:, w])
    own = member[:12]
    found = brown_lm.gains(*sides, own, np.diagonal(pairs)[:12].copy(), table(member), 3)
    for w in range(12):
        plain = [brown_lm.information(table(np.where(np.arange(14) == w, d, member))) for d in range(3)]
        assert np.allclose(found[w] - found[w, 0], np.array(plain) - plain[0])


def test_rare_words_need_few_logarithms(monkeypatch):
    """Words seen two or three times, and some often or beside themselves: same gains, small counts looked up."""
    r = np.random.RandomState(3)
    count, k = 3000, 40
    size, log, taken = k + 2, brown_lm._log, []
    own = r.randint(0, k + 1, count)
    sides, self_ = np.zeros((2, count, size)), np.zeros(count)
    for _ in range(3):
        for side in sides:
            np.add.at(side, (np.arange(count), r.randint(0, size, count)), 1)
    for w in range(0, count, 100):
        own[w], self_[w] = w // 100, w % 7
        sides[:, w] += r.randint(0, 60, size)
        sides[:, w, own[w]] += self_[w]
    table = np.zeros((size, size))
    np.add.at(table, own, sides[0])
    np.add.at(table.T, own, sides[1])
    table += r.randint(0, 5, table.shape)

    def information(w, d):
        t, o = table.copy(), own[w]
        for mine, here in ((sides[0, w], t), (sides[1, w], t.T)):
            here[o] -= mine
            beside = mine.copy()
            beside[o] -= self_[w]
            here[d] += beside
        t[o, o] += self_[w]
        t[d, d] += self_[w]
        return brown_lm.information(t)

    def counted(x):
        taken.append(np.size(x))
        return log(x)

    monkeypatch.setattr(brown_lm, "_log", counted)
    found = brown_lm.gains(*sides, own, self_, table, k)
    # Two tables of small counts for each class and neighbour's class, and little for a word.
    assert sum(taken) < 100 * count
    for w in (*range(0, count, 500), *range(1, count, 300)):
        plain = [information(w, d) for d in range(k)]
        assert np.allclose(found[w] - found[w, 0], np.array(plain) - plain[0])


def test_blocks_are_the_words_of_the_texts():
    def plain(word):
        size = 0 if len(word) < 4 else 1 if len(word) < 7 else 2 if len(word) < 11 else 3
        last = word[-1]
        small = 0 if last in b"aeiou" else 1 if last in b"dnrst" else 2
        end = small if 97 <= last <= 122 else 3 if 48 <= last <= 57 else 4 if last > 127 else 5
        digit = any(48 <= b <= 57 for b in word)
        return (size * 6 + end) * 4 + (1 if digit else 0 if word.isalpha() else 2 if word.isascii() else 3)

    r = cases.rng(6)
    letters = [*map(chr, range(256)), *" " * 60, *"\u4e2d\u2003\x85\U0001f600AZaz09"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " ", "\x1c a\x00b \x1f", "  A B  "]
    want = [[] if t is None else t.encode().lower().split() for t in texts]
    for room in (0, 500, 10**9):
        found = []
        for block in brown_lm.blocks((pa.array(texts[i : i + 50]) for i in range(0, len(texts), 50)), room):
            words = block.words.to_pylist()
            tokens = iter(block.numbers.tolist())
            found += [[words[next(tokens)] for _ in range(n)] for n in block.lengths.tolist()]
            assert next(tokens, None) is None
            assert brown_lm.forms(block.words).tolist() == list(map(plain, words))
            strings = np.array([w.decode() for w in words], object)
            hashes = pd.util.hash_array(strings, categorize=False).view(np.int64)
            assert (brown_lm.word_hashes(block.words) == hashes).all()
        assert found == want
    (block,) = brown_lm.blocks([pa.array([None, " "])], 0)
    assert block.lengths.tolist() == [0, 0] and not len(block.words) and not len(block.numbers)


def test_packed_numbers_come_back():
    for numbers in ([], [0], [0, 0, 300], [7] * 1000, [-1, 5, -(2**63), 2**63 - 1], [*range(0, 10**7, 999)]):
        packed = brown_lm._pack(np.array(numbers, np.int64))
        assert brown_lm._unpack(pa.scalar(packed)).tolist() == numbers


def test_cuts_of_long_lines_do_not_show(two_languages):
    """However lines are cut and texts read in sections, labels are those of the whole line."""
    r = cases.rng(8)
    one, two = "thewher therwhed ther thing edwh".split(), "eau oueau quequeé eauou éeau".split()
    texts = []
    for _ in range(12):
        words = []
        for _ in range(r.randint(1, 8)):
            words += [r.choice(r.choice([one, two])) for _ in range(r.randint(1, 40))]
            words.append(r.choice([",", "\n", "12", "\n\n", ""]))
        texts.append(" ".join(words))
    texts += ["", "  \n", "12 !", "é" * 3000, " ".join(one * 60)]
    whole = replace(two_languages, settings=replace(two_languages.settings, sequence=100_000))
    expected = language.label(whole, texts, runs=True)
    for sequence, section, block in ((1, 7, 50), (2, 100, 400_000), (5, 64, 1), (64, 1 << 16, 400_000)):
        settings = replace(two_languages.settings, sequence=sequence, section=section, block=block)
        found = language.label(replace(two_languages, settings=settings), texts, runs=True)
        for a, b in zip(found, expected, strict=True):
            assert (a.language, a.letters, a.words, a.switched, a.runs) == (
                b.language, b.letters, b.words, b.switched, b.runs,
            )
            assert a.score == pytest.approx(b.score, abs=1e-9)


def test_chains_are_enumerated_over_cuts():
    """Against the sum over all label sequences of a line, with cuts after every word or two."""
    rng = np.random.default_rng(3)
    for n, k, longest in ((5, 2, 1), (6, 3, 2), (4, 2, 3)):
        scores, start, moves = rng.normal(size=(n, k)), rng.normal(size=k), rng.normal(size=(k, k))
        weight = np.zeros((n, k))
        for labels in itertools.product(range(k), repeat=n):
            total = start[labels[0]] + scores[0, labels[0]]
            total += sum(moves[a, b] + scores[t + 1, b] for t, (a, b) in enumerate(itertools.pairwise(labels)))
            for t, x in enumerate(labels):
                weight[t, x] += np.exp(total)
        expected = weight / weight.sum(axis=1, keepdims=True)
        new_line = np.arange(n) == 0
        found = language.chain_posterior(scores, new_line, longest, start, moves)
        assert np.allclose(found, expected)


def test_a_long_text_needs_little_more_than_its_words(two_languages):
    import tracemalloc

    text = "thewher therwhed eau " * 150_000
    tracemalloc.start()
    found = language.label(two_languages, [text])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.words == 450_000 and peak < 250 << 20


def test_classifier_scores_are_the_plain_ones(ready):
    """Block by block with fresh compressors, and the curve at its best."""
    import zstandard

    docs, labels = documents(ready, FOLDER), ready.read.parquet(f"{FOLDER}/labels.parquet")
    settings = quality_classifier.Settings(each=60, block_bytes=700)
    model = quality_classifier.fit(docs, labels, settings)
    assert model.curve is not None

    def size(dictionary, block):
        data = zstandard.ZstdCompressionDict(dictionary)
        tool = zstandard.ZstdCompressor(
            level=settings.level, dict_data=data, write_checksum=False, write_dict_id=False
        )
        return len(tool.compress(block))

    def plain(text):
        data = (text or "").encode()
        blocks = [data[i : i + 700] for i in range(0, len(data), 700)]
        saved = sum(size(model.bad, b) - size(model.good, b) for b in blocks)
        z = model.curve[0] * (saved / len(data) if data else 0.0) + model.curve[1]
        return 1 / (1 + math.exp(-z))

    rows = [r for r in cases.texts() if r[1] is None or len(r[1]) < 30_000]
    found = quality_classifier.score(cases.frame(ready, rows), model).collect()
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in found)
    assert got == sorted((str(i), round(plain(t), 6)) for i, t, *_ in rows)


def test_the_curve_is_the_most_likely_one():
    rng = np.random.default_rng(1)
    x = rng.normal(size=400) / 50
    y = (rng.random(400) < 1 / (1 + np.exp(-(90 * x + 0.5)))).astype(float)
    weight = rng.uniform(0.5, 2, 400)
    slope, intercept = quality_classifier._curve(x, y, weight)

    def likelihood(a, b):
        z = a * x + b
        penalty = 5e-4 * ((a * x.std()) ** 2 + b**2)
        return float((weight * (y * z - np.logaddexp(0, z))).sum()) - penalty

    best = likelihood(slope, intercept)
    for a, b in ((1.02, 0), (0.98, 0), (1, 0.02), (1, -0.02), (1.01, 0.01)):
        assert likelihood(slope * a, intercept + b) < best


@pytest.mark.parametrize("chunk_bytes", [2_000, 12 << 20])
def test_language_model_scores_are_the_plain_sum(ready, chunk_bytes):
    """Word by word: transition of classes and emission, from the table of classes and counts."""
    settings = brown_lm.Settings(exchanged=40, classes=5, chunk_bytes=chunk_bytes)
    rows = cases.texts() + [(50 + i, "one two three four", "en", "a") for i in range(40)]
    docs = cases.frame(ready, rows)
    known = docs.filter(~remainder_is(F.col("doc_id"), 5, 1)).select("text")
    counts = brown_lm.word_counts(known, settings).checkpoint()
    model = brown_lm.fit(known, counts, settings)
    class_of = {r["word"]: r["class"] for r in model.classes.collect()}
    n_of = Counter()
    for i, t, *_ in rows:
        if cases.crc(i, 5) != 1:
            n_of.update(w.lower() for w in cases.words(t))
    tokens, words = Counter(), Counter()
    for w, n in n_of.items():
        c = class_of[int(brown_lm.word_hashes([w])[0])]
        tokens[c] += n
        words[c] += 1

    def plain(text):
        total, before = 0.0, len(model.transition) - 1
        for w in (x.lower() for x in cases.words(text)):
            n = n_of.get(w, 0)
            c = class_of[int(brown_lm.word_hashes([w])[0])] if n else int(model.form_class[brown_lm.form(w)])
            prior = settings.emission_prior
            total += model.transition[before, c]
            total += math.log10((n + prior) / (tokens[c] + prior * (words[c] + 1)))
            before = c
        return total + model.transition[before, len(model.transition) - 1]

    found = brown_lm.score(docs, counts, model).collect()
    got = sorted((str(r.doc_id), round(r.score, 4)) for r in found)
    assert got == sorted((str(i), round(float(plain(t)), 4)) for i, t, *_ in rows)
    assert np.allclose((10.0**model.transition).sum(axis=1), 1.0)
