"""Spelling variants against all pairs, and the machines against plain sets."""

import itertools
import random
import re
import zlib
from collections import Counter

import cases
import pytest

from sitelens.llm import spelling
from sitelens.llm.common import documents
from sitelens.llm.spelling import Acceptor, Composition, Settings

FOLDER = "/root/testdata/sf0.001"
LOWERED = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(u, v):
    """Whether one letter inserted, deleted or replaced turns one into the other."""
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    i = 0
    while i < len(u) and u[i] == v[i]:
        i += 1
    return u[i + 1 :] == v[i + 1 :] if len(u) == len(v) else u[i:] == v[i + 1 :]


def counted(rows, slip, least_length, least_count):
    n = Counter()
    for i, text, *_ in rows:
        for match in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            word = match[0].translate(LOWERED)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if slip and h % slip == 0:
                place = h % len(word)
                word = word[:place] + word[place + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def plain(n, times=2):
    partners = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, found in partners.items():
        if found:
            best = min(found, key=lambda v: (-n[v], v))
            if n[best] >= times * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(partners[w]), n.get(form.get(w))))
    return sorted(out, key=str)


def got(found):
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("narrow", [Settings(), Settings(letters=6, width=2)])
def test_variants_of_documents_are_those_of_all_pairs(ready, narrow):
    rows = [(r.doc_id, r.text) for r in documents(ready, FOLDER).limit(60).collect()]
    docs = cases.frame(ready, [(i, t, None, None) for i, t in rows])
    words = spelling.occurrences(docs, slip=97, least_length=5)
    found = spelling.variants(spelling.vocabulary(words, narrow), narrow)
    assert got(found) == plain(counted(rows, 97, 5, 3))


def test_odd_texts_and_no_texts(ready):
    settings_ = Settings(least_length=2, least_count=1, width=3)
    docs, rows = cases.frame(ready), cases.texts()
    for slip in (None, 3):
        words = spelling.occurrences(docs, slip=slip, least_length=settings_.least_length)
        n = counted(rows, slip, 2, 1)
        found = spelling.variants(spelling.vocabulary(words, settings_), settings_)
        short = {w: c for w, c in n.items() if len(w) < 1000}
        expected = [x for x in plain(short)]
        assert [x for x in got(found) if len(x[0]) < 1000] == expected
        assert found.count() == len(n)
    none = spelling.vocabulary(spelling.occurrences(cases.empty(ready)))
    assert spelling.variants(none).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_hot_blocks_are_split_and_ties_are_ordered(ready, seed):
    """Few letters, so nearly all words are near many others; equal counts; very long words."""
    r = random.Random(seed)
    n = {"".join(r.choices("ab", k=r.randint(2, 7))): r.choice([3, 3, 6, 12]) for _ in range(90)}
    long_ = "ab" * 300
    n |= {long_: 5, long_ + "b": 10, long_[:250] + "x" + long_[251:]: 40, long_[:-1]: 3, "é" * 9: 4}
    vocabulary = ready.createDataFrame(list(n.items()), "word string, n long")
    for settings_ in (Settings(least_length=2), Settings(least_length=2, letters=10, width=1)):
        assert got(spelling.variants(vocabulary, settings_)) == plain(n)


def test_chains_of_forms_are_followed_to_the_end(ready):
    """Each word twice as frequent as the one before and one letter longer."""
    n = {"a" * (5 + k): 3 * 2**k for k in range(12)}
    vocabulary = ready.createDataFrame(list(n.items()), "word string, n long")
    found = {r.word: r for r in spelling.variants(vocabulary).collect()}
    assert {r.root for r in found.values()} == {"a" * 16}
    assert found["a" * 16].form is None and found["aaaaa"].form == "aaaaaa"


@pytest.mark.parametrize("seed", range(5))
def test_acceptors_are_minimal_and_compositions_complete(seed):
    r = random.Random(seed)
    draw = lambda k: sorted({"".join(r.choices("abc", k=k)) for _ in range(25)})
    short, long_ = draw(4), draw(5)

    def language(machine, state):
        out = {""} if machine.final[state] else set()
        for letter, after in machine.next[state].items():
            out |= {letter + x for x in language(machine, after)}
        return out

    for words in (short, long_, sorted([*short, *long_])):
        machine = Acceptor(words)
        assert language(machine, 0) == set(words)
        reached, todo = {0}, [0]
        while todo:
            for after in machine.next[todo.pop()].values():
                if after not in reached:
                    reached.add(after)
                    todo.append(after)
        languages = [frozenset(language(machine, s)) for s in reached]
        assert len(set(languages)) == len(languages)
    one, two = Acceptor(short), Acceptor(long_)
    pairs = Composition(one, one).replaced()
    assert sorted(pairs) == sorted((u, v) for u, v in itertools.combinations(short, 2) if near(u, v))
    pairs = Composition(one, two).inserted()
    assert sorted(pairs) == sorted((u, v) for u in short for v in long_ if near(u, v))
