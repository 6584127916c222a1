"""Packing: ids against the library, pieces that give documents back, full sequences."""

import random
import struct
import zlib
from collections import defaultdict
from pathlib import Path

import cases
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitelens.llm import packing
from sitelens.llm.common import documents
from sitelens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
ENCODER = packing.Encoder(Path(PATH).read_text())


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


PARTS = st.sampled_from(
    [*"aAbZé ÀßÿÉ×÷'st0129.,-_#\n\t\x0b\x1c\x85\xa0½²µª中文ΣσςİıǅÅ̊̀​　🙂",
     "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "  ", "\r\n"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25))
def test_ids_are_those_of_the_library(parts):
    text = "".join(parts)
    assert unpacked(ENCODER.encode(text)) == library(text)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_sections_change_nothing(size, monkeypatch):
    monkeypatch.setattr(packing.sections, "__defaults__", (size,))
    text = cases.prose(5, 300).replace(" ", "  \n", 20) + "x" * 500 + " É中 <|endoftext|> end "
    assert "".join(packing.sections(text)) == text
    assert unpacked(ENCODER.encode(text)) == library(text)


def test_a_small_table_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    monkeypatch.setattr(packing, "LONG_WORD", 6)
    tool = packing.Encoder(Path(PATH).read_text())
    for seed in range(5):
        text = cases.prose(seed, 200)
        assert unpacked(tool.encode(text)) == library(text)


@pytest.mark.parametrize("longest", [1, 2, 64, 2048])
def test_lengths_are_powers_of_two_that_add_up(longest):
    for tokens in [*range(1, 300), 2047, 2048, 2049, 10_000]:
        found = packing.lengths(tokens, longest)
        assert sum(found) == tokens and found == sorted(found, reverse=True)
        assert all(x & (x - 1) == 0 and x <= longest for x in found)
        short = [x for x in found if x < longest]
        assert len(set(short)) == len(short)


def check(rows, expected, longest):
    """Every document is given back by its pieces, and every sequence is one full piece."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= longest
    numbers = [r.sequence_id for r in rows]
    assert len(set(numbers)) == len(numbers)
    # Sorting sequences by their number sorts them by length.
    ordered = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert ordered == sorted(ordered)
    assert set(by_doc) == set(expected)
    for doc, texts in expected.items():
        whole = sorted(tuple([*library(t), 1]) for t in texts)
        found, current = [], []
        for r in sorted(by_doc[doc], key=lambda r: r.sequence_id >> 33 & ((1 << 26) - 1)):
            current.append(r)
        assert sum(r.length for r in current) == sum(map(len, whole))
        if len(texts) == 1:
            ids = []
            for r in sorted(current, key=lambda r: r.start):
                assert r.start == len(ids) and r.doc_tokens == len(whole[0])
                ids += unpacked(r.ids)
            found.append(tuple(ids))
            assert found == whole


@pytest.mark.parametrize("longest", [4, 2048])
def test_pieces_give_documents_back(ready, longest):
    rows = cases.texts()
    pieces = packing.pack(cases.frame(ready), Path(PATH).read_text(), 1, longest=longest)
    expected = defaultdict(list)
    for i, t, *_ in rows:
        expected[i].append(t)
    check(pieces.collect(), expected, longest)
    none = packing.pack(cases.empty(ready), Path(PATH).read_text(), 1)
    assert none.collect() == []
    with pytest.raises(ValueError, match="power"):
        packing.pack(cases.frame(ready), "", 1, longest=12)


def test_the_query_is_the_library_cut(ready):
    found = QUERIES["op12_packing"](ready, FOLDER).collect()
    texts = {r.doc_id: r.text for r in documents(ready, FOLDER).collect()}
    assert {r.doc_id for r in found} == set(texts)
    for r in random.Random(1).sample(found, 200):
        ids = [*library(texts[r.doc_id]), 1]
        assert r.doc_tokens == len(ids)
        own = ids[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
    total = sum(r.length for r in found)
    assert total == sum(len(library(t)) + 1 for t in texts.values())


def test_buckets_are_folders_of_equal_length(ready, tmp_path):
    pieces = packing.pack(documents(ready, FOLDER).limit(20), Path(PATH).read_text(), 1)
    packing.write_buckets(pieces, str(tmp_path / "packed"))
    for folder in (tmp_path / "packed").glob("length=*"):
        length = int(folder.name.removeprefix("length="))
        sizes = {len(r.ids) for r in ready.read.parquet(str(folder)).collect()}
        assert sizes == {4 * length}
