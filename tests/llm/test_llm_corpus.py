"""Quality rules, mixing, near duplicates, fingerprints and the pipeline against brute force."""

import math
import os
import re
from collections import Counter, defaultdict

import cases
import hashlib
import pytest
import xxhash
from pyspark.sql import functions as F

from sitelens.llm import mixing, near_duplicates, order_minhash, quality_rules
from sitelens.llm.common import components, documents

FOLDER = "/root/testdata/sf0.001"


def plain_rules(text):
    text = text or ""
    words = cases.words(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {j for v in windows.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (
        len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated), failed,
    )


def plain_grams(text, buckets):
    words = cases.words(text)
    hash_ = lambda data, seed: xxhash.xxh64_intdigest(data, seed)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    single = [signed(hash_(w, 42)) % buckets for w in words]
    pairs = [signed(hash_(b, hash_(a, 42))) % buckets for a, b in zip(words, words[1:], strict=False)]
    return single + pairs


@pytest.mark.parametrize("buckets", [64, 1 << 12])
def test_quality_rules_are_the_plain_ratio(ready, buckets):
    rows = cases.texts()
    docs = cases.frame(ready)
    trusted = ready.createDataFrame([(1,), (9,), (9,), (77,), (None,)], "id long")
    raw, good = Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(plain_grams(t, buckets))
        if i in (1, 9):
            good.update(plain_grams(t, buckets))
    raws, goods = sum(raw.values()), sum(good.values())
    ratio = [
        math.log((good[b] + 1) / (goods + buckets)) - math.log((raw[b] + 1) / (raws + buckets))
        for b in range(buckets)
    ]
    found = quality_rules.judge(
        docs, quality_rules.ratios(docs, trusted, buckets=buckets), buckets=buckets, threshold=-0.1
    ).collect()
    got, expected = [], []
    for r in found:
        got.append((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed, round(r.score, 9), r.kept))
    for i, t, *_ in rows:
        grams = plain_grams(t, buckets)
        score = sum(ratio[g] for g in grams) / max(1, len(grams))
        rules = plain_rules(t)
        expected.append((str(i), *rules, round(score, 9), not rules[-1] and score >= -0.1))
    assert sorted(got) == sorted(expected)
    none = cases.empty(ready)
    assert quality_rules.judge(none, quality_rules.ratios(none, trusted)).collect() == []


def test_quality_rules_keep_labelled_good(ready):
    folder = "/root/testdata/sf0.01"
    docs, labels = documents(ready, folder), ready.read.parquet(f"{folder}/labels.parquet")
    trusted = labels.filter("quality = 1").select(F.col("doc_id").alias("id"))
    found = quality_rules.judge(docs, quality_rules.ratios(docs, trusted)).join(labels, "doc_id")
    rows = found.filter("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) == len(good) and sum(bad) < 0.2 * len(bad)


def plain_components(rows, percent=85):
    sets = []
    for _, t, *_ in rows:
        w = [x.lower() for x in cases.words(t)]
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        sets.append(frozenset(grams))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & sets[j])
                if sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(
        (str(doc), len(sets[i]), str(least.get(top(i)) if doc is not None else None))
        for i, (doc, *_) in enumerate(rows)
    )


def got_components(found):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found.collect())


@pytest.mark.parametrize(
    "settings",
    [near_duplicates.Settings(), near_duplicates.Settings(block=2, small_band=2)],
    ids=["usual", "tiny blocks"],
)
def test_components_are_the_plain_ones(ready, settings):
    rows = cases.texts()
    chain = cases.prose(50, 120).split()
    for step in range(12):  # neighbours are linked, the ends are not
        chain = [*chain[:-1]]
        chain[step * 9] = f"changed{step}"
        rows.append((100 + step, " ".join(chain), "en", "a"))
    base = cases.prose(60, 150).split()
    for i in range(30):  # a large group of near copies
        rows.append((200 + i, " ".join([*base[: 5 + i], f"new{i}", *base[6 + i :]]), "en", "a"))
    found = near_duplicates.find(cases.frame(ready, rows), settings)
    assert got_components(found) == plain_components(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found.collect())
    assert near_duplicates.find(cases.empty(ready), settings).collect() == []


def test_repeated_ids_with_other_texts_are_told_apart(ready):
    rows = [(1, cases.prose(1, 60), "en", "a"), (1, cases.prose(2, 60), "en", "a"),
            (2, cases.prose(2, 60) + " more", "en", "a"), (3, cases.prose(3, 60), "en", "a")]
    assert got_components(near_duplicates.find(cases.frame(ready, rows))) == plain_components(rows)


def test_one_row_of_every_component_stays(ready):
    docs = cases.frame(ready)
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(ids) == Counter([1, 4, 5, 6, 7, 8, 9, 10, 11, None, None, 13, 14, 15])


def test_rows_that_share_an_id_are_kept_by_their_text(ready):
    one, two, three = (cases.prose(n, 60) for n in (1, 2, 3))
    rows = [(1, one, "en", "a"), (1, two, "en", "a"), (1, two, "en", "a"), (2, two + " more", "en", "a"),
            (5, three, "en", "a"), (7, three, "en", "a"), (7, cases.prose(4, 60), "en", "a"),
            (8, "", "en", "a"), (8, None, "en", "a"), (8, cases.prose(5, 60), "en", "a")]
    docs = cases.frame(ready, rows)
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert got == Counter([(1, one), (1, two), (5, three), (7, rows[6][1]), (8, ""), (8, rows[9][1])])


def test_bounds_of_the_posterior():
    settings = near_duplicates.Settings()
    for n, least in near_duplicates.least_matches(settings):
        below = sum(math.comb(n + 1, m) * 0.85**m * 0.15 ** (n + 1 - m) for m in range(least))
        assert below < settings.miss


def test_connected_components(ready):
    r = cases.rng(9)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(999, 999)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components(ready.createDataFrame(edges, "a long, b long")).collect()
    assert {(x.node, x.root) for x in found} == set(root.items()) and len(found) == len(root)


def test_fingerprints(ready):
    sign = order_minhash.signature
    text = cases.prose(1, 400)
    assert order_minhash.likeness(sign(text), sign(text)) == 1.0
    small = order_minhash.likeness(sign(text), sign(text[:1000] + "x" + text[1001:]))
    large = order_minhash.likeness(sign(text), sign(text[: len(text) // 2] + cases.prose(2, 200)))
    none = order_minhash.likeness(sign(text), sign(cases.prose(3, 400).upper()))
    assert 0.9 < small < 1.0 and none < 0.05 < large < small
    words = text.split()
    moved = " ".join(words[200:] + words[:200])  # the same k-mers in another order
    assert order_minhash.likeness(sign(text), sign(moved)) < 0.75
    assert order_minhash.likeness(sign(""), sign("")) == 1.0
    assert order_minhash.likeness(sign(""), sign("a")) == 0.0 and sign("a").any()


@pytest.mark.parametrize("range_rows", [4000, 3])
def test_next_text_in_descending_order(ready, range_rows, monkeypatch):
    monkeypatch.setattr(order_minhash, "RANGE_ROWS", range_rows)
    rows = [r for r in cases.texts() if r[0] is not None or r[1] is not None]
    seen = {r[:2]: r for r in rows}
    ordered = sorted(seen.values(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    expected = set()
    for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        x, y = a[1] or "", b[1] or ""
        changed = order_minhash.edited(x, y)
        if a[0] != 12:  # the repeated row follows itself once
            expected.add((str(a[0]), len(x), hashlib.sha256(changed.encode()).hexdigest()))
    found = order_minhash.compare_with_next(cases.frame(ready, rows)).collect()
    assert len(found) == len(rows)
    got = {(str(r.doc_id), r.n_chars, r.edited_sha256) for r in found if r.doc_id != 12}
    assert got == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert order_minhash.compare_with_next(cases.empty(ready)).collect() == []
    one = order_minhash.compare_with_next(cases.frame(ready, [(5, "abcdef", None, None)])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_exponent_meets_the_limits(ready):
    totals = ready.createDataFrame([(1000,), (100,), (10,), (0,)], "tokens long")
    p = [x / 1110 for x in (1000, 100, 10)]

    def entropy(a):
        q = [x**a / sum(y**a for y in p) for x in p]
        return -sum(x * math.log(x) for x in q)

    a = mixing.exponent(totals, repetition_limit=4.0)
    assert math.isclose((10 / 1000) ** (a - 1), 4.0, rel_tol=1e-9)
    a = mixing.exponent(totals, repetition_limit=None, entropy=0.6)
    assert math.isclose(entropy(a), 0.6, rel_tol=1e-9)
    a = mixing.exponent(totals, repetition_limit=3.0, budget=500.0)
    q = [x**a / sum(y**a for y in p) for x in p]
    assert math.isclose(500 * q[2] / 10, 3.0, rel_tol=1e-9)
    assert mixing.exponent(totals, repetition_limit=None) == 0.0
    assert mixing.exponent(totals.filter("tokens < 0")) == 1.0


def test_mixture_keeps_to_budget_and_limit(ready):
    rows = [(i, "w " * (1 + i % 7), "en", "big" if i % 10 else f"small{i % 3}") for i in range(2000)]
    rows += [(5000, None, "en", None), (5001, "a b c", "en", None), (None, "q r", "en", "big")]
    docs = cases.frame(ready, rows)
    slim = mixing.lengths(docs).checkpoint()
    sources, limits = mixing.plan(slim, repetition_limit=3.0, block_tokens=50)
    uses = mixing.schedule(slim, sources, limits).collect()
    count = Counter((r.doc_id, r.source) for r in uses)
    assert set(count) == {(i, s) for i, _, _, s in rows} and max(count.values()) <= 3
    want = {r.source: r for r in sources.collect()}
    for name, source in want.items():
        used = sum(r.n_tokens for r in uses if r.source == name)
        assert used <= source.passes * source.tokens + 1e-6
        assert used >= source.passes * source.tokens - 8  # less than the longest document is left
    assert math.isclose(sum(r.weight for r in want.values()), 1.0)
    full = mixing.mixed(docs, sources, limits)
    assert full.columns == docs.columns
    assert Counter((r.doc_id, r.source) for r in full.collect()) == count
    low, ends = mixing.plan(slim, repetition_limit=3.0, budget=500.0, block_tokens=50)
    part = mixing.schedule(slim, low, ends).collect()
    assert 400 < sum(r.n_tokens for r in part) <= 500


def test_mixture_cases(ready):
    for docs, n in ((cases.empty(ready), 0), (cases.frame(ready), None)):
        slim = mixing.lengths(docs).checkpoint()
        plan = mixing.plan(slim)
        uses = mixing.schedule(slim, *plan).collect()
        assert mixing.mixed(docs, *plan).count() == len(uses)
        if n is None:
            texts = Counter(i for i, *_ in cases.texts())
            got = Counter(r.doc_id for r in uses)
            assert set(got) == set(texts) and all(texts[i] <= got[i] <= 2 * texts[i] for i in texts)
        else:
            assert len(uses) == n


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_pipeline_is_its_stages_one_by_one(ready):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from sitelens.llm import credentials, quality_classifier
    from sitelens.llm.common import text_bytes  # noqa: F401

    docs = documents(ready, FOLDER)
    labels = ready.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    score = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect() if score[r.doc_id] >= 0.3]
    stay = {int(i) for i, _, c in plain_components(rows) if i == c}
    rows = [(i, credentials.redacted(t), lang, s) for i, t, lang, s in rows if i in stay]
    left = ready.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    slim = mixing.lengths(left).checkpoint()
    uses = Counter(r.doc_id for r in mixing.schedule(slim, *mixing.plan(slim)).collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for i, t, *_ in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected += [(i, len(ids), digest)] * uses[i]
    found = corpus_pipeline.run(ready, FOLDER).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in found) == sorted(expected)


def test_stages_take_any_columns(ready, tmp_path):
    import corpus_pipeline

    ready.createDataFrame([(1, 1, 0), (14, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for docs in (cases.frame(ready), cases.empty(ready)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(ready, docs, str(tmp_path))
            if name != "bpe":
                assert found.columns == docs.columns
            found.collect()


def test_batches_are_bounded_by_bytes(ready):
    """A batch of long documents is as many rows as fit, not a thousand of them."""
    from sitelens.llm.common import BATCH_BYTES, map_batches

    long_ = ready.range(200).selectExpr("repeat('x', 1000000) AS text").coalesce(1)

    def sizes(batch):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    found = [r.n for r in map_batches(long_, sizes, "n long").collect()]
    assert sum(found) == 200 and max(found) <= BATCH_BYTES // 1_000_000 + 2


def plain_signature(text, kmer, slots, size):
    """Slot by slot, with the numbers of k-mers counted one after another."""
    mask = (1 << 64) - 1
    c = [int(x) for x in order_minhash._C]

    def mixed(h):
        h &= mask
        h = ((h ^ (h >> 30)) * c[1]) & mask
        h = ((h ^ (h >> 27)) * c[2]) & mask
        return h ^ (h >> 31)

    if not text:
        return [0] * slots
    codes = [ord(x) for x in text]
    if len(codes) < kmer:
        data = text.encode("utf-32-le", "surrogatepass")
        import numpy as np

        wide = np.frombuffer(data, np.uint32).astype(np.uint64).tobytes()
        grams = [int.from_bytes(hashlib.blake2b(wide, digest_size=8).digest(), "little")]
    else:
        import numpy as np

        with np.errstate(over="ignore"):
            grams = order_minhash._kmers(np.array(codes, np.uint64), kmer).tolist()
    met = Counter()
    entries = []
    for place, gram in enumerate(g >> 32 for g in grams):
        value = mixed(gram * c[0] + met[gram] * c[1])
        met[gram] += 1
        entries.append((value, place, gram))
    out = []
    for slot in range(slots):
        mine = [e for e in entries if (e[0] >> 32) * slots >> 32 == slot]
        if len(mine) >= size:
            picked = sorted(mine, key=lambda e: e[0] & 0xFFFFFFFF)[:size]
        else:
            picked = sorted(entries, key=lambda e: mixed(e[0] + (slot + 1) * c[2]))[:size]
        total, weight = 0, 1
        for _, _, gram in sorted(picked, key=lambda e: e[1]):
            weight = weight * c[0] & mask
            total += mixed(gram + c[2]) * weight
        out.append(mixed(total) % 65535 + 1)
    return out


@pytest.mark.parametrize("size", [1, 2, 3])
def test_signatures_are_those_of_every_slot_on_its_own(size):
    texts = [t for _, t, *_ in cases.texts() if t is None or len(t) < 3000]
    texts += [cases.prose(3, n) for n in (1, 5, 20, 60, 150, 400)] + ["ab" * n for n in (1, 4, 5, 40, 700)]
    for text in texts:
        found = order_minhash.signature(text or "", 8, 16, size).tolist()
        assert found == plain_signature(text or "", 8, 16, size), text


def test_short_texts_fill_every_slot_and_see_their_order():
    for n in (8, 9, 12, 40, 67, 120):
        text = cases.prose(n, 60)[:n]
        found = order_minhash.signature(text)
        assert (found > 0).all()
        if n >= 40:
            turned = text[n // 2 :] + text[: n // 2]
            assert order_minhash.likeness(found, order_minhash.signature(turned)) < 0.8
            changed = text[:-3] + "zzz"
            assert 0.3 < order_minhash.likeness(found, order_minhash.signature(changed)) < 1.0


def test_rows_without_ids_are_dealt_to_ranges(ready, monkeypatch):
    """In descending order of ids, then of a hash of the text where there is none."""
    monkeypatch.setattr(order_minhash, "RANGE_ROWS", 3)
    rows = [(i if i % 3 else None, cases.prose(i, 3 + i % 7), "en", "a") for i in range(60)]
    found = order_minhash.compare_with_next(cases.frame(ready, rows)).collect()
    signed = lambda t: (h := xxhash.xxh64_intdigest(t, 42)) - (1 << 64) * (h >> 63)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])), reverse=True)
    expected = set()
    for a, b in zip(order, [*order[1:], order[0]], strict=True):
        changed = order_minhash.edited(a[1], b[1])
        expected.add((str(a[0]), len(a[1]), hashlib.sha256(changed.encode()).hexdigest()))
    assert {(str(r.doc_id), r.n_chars, r.edited_sha256) for r in found} == expected and len(found) == 60


def test_blocks_are_bounded_by_bytes_too(ready):
    """Tiny bounds: the same components however the sets are dealt to blocks."""
    base = cases.prose(70, 400).split()
    rows = [(i, " ".join([*base[: 5 + 9 * i], f"new{i}", *base[6 + 9 * i :]]), "en", "a") for i in range(25)]
    rows += cases.texts()
    settings = near_duplicates.Settings(block_bytes=8 * 900, small_band=2)
    found = near_duplicates.find(cases.frame(ready, rows), settings)
    assert got_components(found) == plain_components(rows)


def test_a_worker_keeps_the_tables_of_one_module(monkeypatch):
    from sitelens.llm import common

    kept = {"one": [1], "two": [2]}
    monkeypatch.setattr(common, "_TABLES", {name: table.clear for name, table in kept.items()})
    common.others_forget("one")
    assert kept == {"one": [1], "two": []}
    common.others_forget("three")
    assert kept == {"one": [], "two": []}
