"""Personal data, credentials and BPE against plain references."""

import hashlib
import re
from array import array

import cases
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitelens.llm import bpe, credentials, pii

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json")).read()
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += sum(divmod(int(c) * 2, 10)) if i % 2 else int(c)
    return total % 10 == 0


def plain_pii(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def plain_secrets(text):
    out = []
    names = "password passwd secret token apikey api_key".split()
    either = "|".join("".join(f"[{c}{c.upper()}]" if c != "_" else c for c in n) for n in names)
    pattern = rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


PII_PARTS = ["1", "22", "255", "4111111111111111", "378282246310005", ".", "-", " ", "+", "@", "a",
             "b.c", "x@y.z", "(", ")", "é", "http://", "account: ", "٣", "\n", "https://a.b/c?d"]
SECRET_PARTS = ["password", "PassWord", "ſecret", "secret", "toKen", "api_key", "apikey", "=", ":",
                " ", '"', "'", "abcdef0123456789" * 2, "AKIA", "ABCDEFGH12345678", "x", "12345678",
                "\n", "\n\n", "http://h.example:80/", "user=bob", "é", "wJalrXUtnFEMI/K7MDENG+bPx"]
BPE_PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "<|endoftext|>", "中", "\x1c", "\x85", "\x00",
             "１", "½", "!", "...", "the", "ing", "x" * 30, "​", "🙂", "=", "-" * 40, "\r\n", "\xa0"]


def joined(parts):
    return st.lists(st.sampled_from(parts), max_size=25).map("".join)


@settings(max_examples=1500, deadline=None)
@given(joined(PII_PARTS))
def test_pii_base_is_the_plain_search(text):
    assert [s for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == plain_pii(text)


@settings(max_examples=1500, deadline=None)
@given(joined(SECRET_PARTS))
def test_secret_base_is_the_plain_search(text):
    base = [s for s in credentials.spans(text) if s[0] in credentials.BASE_KINDS]
    assert base == plain_secrets(text)


@settings(max_examples=800, deadline=None)
@given(joined(BPE_PARTS) | st.text(max_size=60))
def test_bpe_is_the_library(text):
    tool = bpe.encoder(DEFINITION)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert tool.encode(text) == ids
    assert tool.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 5000, "=" * 3000, "ab" * 3000, "é" * 999 + "-" * 777, " " * 999])
def test_bpe_streams_long_pre_tokens_with_bounded_state(text):
    tool = bpe.encoder(DEFINITION)
    assert tool.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    machine = bpe.Transducer(tool.merges)
    ids = []
    for byte in text.encode():
        ids += machine.feed(bytes([byte]))
        assert len(machine.seen) <= 3 * tool.merges.lookahead
    ids += machine.finish()
    assert b"".join(tool.bytes_of[i] for i in ids) == text.encode()


def test_decoder_takes_ids_one_at_a_time():
    tool = bpe.encoder(DEFINITION)
    ids = tool.encode("naïve 🙂 中文")
    machine = bpe.Decoder(tool.bytes_of)
    assert "".join(machine.feed([i]) for i in ids) + machine.finish() == "naïve 🙂 中文"
    assert tool.decode(ids[:-1]) == LIBRARY.decode(ids[:-1], skip_special_tokens=False)


def test_cues_and_schemes_add_spans():
    found = dict((k, (s, e)) for k, s, e in pii.spans("see https://a.example/x, IBAN DE89370400440532013000 ok"))
    assert found["url"] == (4, 23) and found["account"] == (30, 52)


def test_weak_parts_count_only_together():
    weak = "wJalrXUtnFEMI7K7MDENGbPxRfiCY"
    assert credentials.spans(f"just {weak} alone") == []
    kinds = [k for k, *_ in credentials.spans(f"user=bobby then {weak} here")]
    assert kinds == ["linked_identifier", "linked_secret"]
    assert credentials.spans(f"user=bobby\n\n{weak}") == []
    assert credentials.spans(f"user=bobby {'word ' * 60} {weak}") == []
    assert [k for k, *_ in credentials.spans("host=db.example token=abcdefgh1")] == ["linked_endpoint", "assign"]


def test_nearest_partner_is_found_as_by_all_pairs():
    r = cases.rng(5)
    for _ in range(300):
        make = lambda: [(s, s + r.randint(1, 30)) for s in (r.randint(0, 900) for _ in range(8))]
        parts, others = make(), make()
        slow = [
            p for p in parts
            if any(min(abs(o[0] - p[1]), abs(p[0] - o[1])) <= 50 and (o[0] >= p[1] or o[1] <= p[0])
                   and (o[0] - p[1] <= 50 if o[0] >= p[1] else p[0] - o[1] <= 50) for o in others)
        ]
        assert credentials.within_reach(parts, others, 50) == slow


def test_parts_link_over_the_whole_scope(ready):
    weak = "wJalrXUtnFEMI7K7MDENGbPxRfiCY"
    lines = "\n".join(f"setting_{i} is of no interest here" for i in range(20))
    text = f"user=bobby\n{lines}\n{weak}"
    kinds = [k for k, *_ in credentials.spans(text, None)]
    assert kinds == ["linked_identifier", "linked_secret"]
    assert weak not in credentials.redacted(text) and "bobby" not in credentials.redacted(text)
    found = credentials.find(cases.frame(ready, [(1, text, "en", "a")])).first()
    assert [s.kind for s in found.spans] == kinds
    apart = text.replace("\n", "\n\n", 1)
    assert credentials.spans(apart, None) == [] and credentials.redacted(apart) == apart


@pytest.mark.parametrize("endpoint", ["HOST=db.example", "Endpoint: db.example", "HTTPS://db.example/x"])
def test_endpoints_in_either_case(endpoint):
    weak = "wJalrXUtnFEMI7K7MDENGbPxRfiCY"
    assert [k for k, *_ in credentials.spans(f"{endpoint} {weak}")] == ["linked_endpoint", "linked_secret"]


def test_partner_in_the_scope_is_found_as_by_all_pairs():
    r = cases.rng(6)
    for _ in range(300):
        make = lambda: [(s, s + r.randint(1, 60)) for s in (r.randint(0, 90) for _ in range(r.randint(0, 4)))]
        parts, others = make(), make()
        slow = [p for p in parts if any(o[0] >= p[1] or o[1] <= p[0] for o in others)]
        assert credentials.within_scope(parts, others) == slow


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_digests_of_every_case(ready):
    docs = cases.frame(ready)
    expected = sorted(
        (str(i), sum(k == "email" for k, *_ in plain_pii(t or "")), digest(plain_pii(t or "")))
        for i, t, *_ in cases.texts()
    )
    found = pii.digest(pii.find(docs), pii.BASE_KINDS, n_email="email").collect()
    assert sorted((str(r.doc_id), r.n_email, r.base_sha256) for r in found) == expected
    expected = sorted((str(i), digest(plain_secrets(t or ""))) for i, t, *_ in cases.texts())
    found = pii.digest(credentials.find(docs), credentials.BASE_KINDS, n_hex="hex").collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in found) == expected
    for operator in (pii.find, credentials.find):
        assert operator(cases.empty(ready)).collect() == []


def test_redaction_keeps_rows_columns_and_clean_texts(ready):
    docs = cases.frame(ready)
    found = credentials.redact(docs)
    assert found.columns == docs.columns and found.schema == docs.schema
    before = sorted(map(repr, docs.filter("doc_id IS NULL OR doc_id <> 13").collect()))
    assert sorted(map(repr, found.filter("doc_id IS NULL OR doc_id <> 13").collect())) == before
    row = found.filter("doc_id = 13").first()
    assert "hunter2" not in row.text and "<secret>" in row.text and row.n_chars == len(row.text)
    assert credentials.redact(cases.empty(ready)).collect() == []


def test_bpe_rows_of_every_case(ready):
    found = bpe.digests(cases.frame(ready), DEFINITION).collect()
    expected = []
    for i, t, *_ in cases.texts():
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((str(i), len(ids), sha(",".join(map(str, ids))), sha(back)))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(expected)
    assert bpe.digests(cases.empty(ready), DEFINITION).collect() == []
    whole = bpe.encode(cases.frame(ready), DEFINITION).filter("doc_id = 9").first()
    assert whole.decoded == cases.texts()[8][1]


#: One pattern for what the search puts together from marks.
ENDPOINT = re.compile(
    r"\b[a-z][a-z0-9+]*://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?"
    r"|\b(?:host|endpoint|server|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::[0-9]+)?",
    re.IGNORECASE | re.ASCII,
)
PIECES = [
    "user=bob1", "host=", "a+b", "://", "x", ":8080", "/p/q", " ", "\n", "\n\n", "\n \t\n", "+", "_", "é",
    "wJalrXUtnFEMI7K7MDENGbPxRfiCY", "AKIA" + "A1" * 8, "token=", "abcdefgh12", "http", "HOST: db", "url='",
    "0123456789abcdef" * 2, "key_id: zed", "1",
]


def joined(seed, most=14):
    r = cases.rng(seed)
    return "".join(r.choice(PIECES) for _ in range(r.randint(1, most)))


def test_endpoints_are_those_of_one_pattern():
    for seed in range(20_000):
        text = joined(seed)
        assert credentials.endpoints(text) == [m.span() for m in ENDPOINT.finditer(text)], text


def plain_linked(text):
    """Every weak part of a section with a partner that does not overlap it, by all pairs."""
    strong = credentials.base_spans(text)
    apart = lambda a, b: a[1] <= b[0] or b[1] <= a[0]
    weak = credentials.weak_parts(text)
    weak = {k: [p for p in v if all(apart(p, s[1:]) for s in strong)] for k, v in weak.items()}
    section = lambda p: sum(m.start() <= p[0] for m in re.finditer(r"\n[ \t]*\n", text))
    identifiers = weak["identifier"] + [s[1:] for s in strong if s[0] == "access"]
    secrets = weak["secret"] + [s[1:] for s in strong if s[0] in ("assign", "hex")]
    partners = {"identifier": secrets, "endpoint": secrets, "secret": identifiers + weak["endpoint"]}
    return sorted(
        (f"linked_{role}", *p)
        for role, parts in weak.items()
        for p in parts
        if any(apart(p, o) and section(p) == section(o) for o in partners[role])
    )


def test_linked_kinds_are_those_of_all_pairs(ready):
    rows = [(seed, joined(seed, 25), None, None) for seed in range(4000)]
    linked = 0
    for seed, text, *_ in rows:
        expected = plain_linked(text)
        linked += bool(expected)
        assert sorted(s for s in credentials.spans(text, None) if s[0].startswith("linked")) == expected
    assert linked > 500
    found = {r.doc_id: r.spans for r in credentials.find(cases.frame(ready, rows[:200])).collect()}
    for seed, text, *_ in rows[:200]:
        got = sorted(tuple(s) for s in found[seed] if s.kind.startswith("linked"))
        assert got == plain_linked(text)


@pytest.mark.parametrize(
    "text",
    ["user=bobby1 host=db.x\nwJalrXUtnFEMI7K7MDENGbPxRfiCY and more\n\n" * 30_000,
     "x: " + "a+" * 300_000, "a://" * 200_000, "b+://" * 200_000, "user " * 200_000, "host   " * 200_000],
)
def test_search_is_linear(text):
    """Each of these took minutes when every start was tried, or every scope read all parts."""
    import time

    begin = time.process_time()
    credentials.spans(text, None)
    assert time.process_time() - begin < 20


def test_bpe_streams_long_pre_tokens_and_sections():
    import time

    tool = bpe.encoder(DEFINITION)
    r = cases.rng(4)
    long_ones = [" " * 200_000, "".join(r.choices("abcdefghij", k=100_000)), "-=" * 50_000]
    begin = time.process_time()
    for text in long_ones:
        assert tool.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert time.process_time() - begin < 30
    prose = cases.prose(3, 60_000) + " <|endoftext|> end  \n " + "é 中 " * 20_000
    parts = list(bpe.sections(prose))
    assert "".join(parts) == prose and len(parts) > 5
    assert max(map(len, parts)) < 2 * bpe.SECTION
    assert tool.encode(prose) == LIBRARY.encode(prose, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 5, 50])
def test_bpe_sections_of_any_size_change_nothing(size, monkeypatch):
    monkeypatch.setattr(bpe.sections, "__defaults__", (size,))
    tool = bpe.encoder(DEFINITION)
    r = cases.rng(size)
    letters = ["a", "the", " ", "  ", "\n", "'s", "é", "中", "<|endoftext|>", "12", "!?", "\u00a0", "\x1c"]
    for _ in range(500):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        assert tool.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_the_decoder_is_fed_part_by_part():
    tool = bpe.encoder(DEFINITION)
    text = "é中🙂 " * 50
    decoder = bpe.Decoder(tool.bytes_of)
    parts = [decoder.feed(array("I", packed)) for packed in tool.packed(text)] + [decoder.finish()]
    assert "".join(parts) == text
