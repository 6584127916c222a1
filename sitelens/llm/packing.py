"""Packing by powers of two: sequences without padding, none of which crosses documents.

The ids of a document, with one id for its end, are cut into pieces whose lengths are powers of two:
as many of the longest length as fit, then the binary digits of the rest from the largest to the
smallest. Each piece is a sequence of its own, and sequences of equal length form a bucket, so a batch
taken from a bucket is a full rectangle. Nothing is padded, nothing is dropped, and no sequence holds
ids of two documents.

A document is cut where it is read: there is no shuffle, and a lost executor repeats its own files. The
number of a sequence says its bucket, the partition that read it and its place there, so sorting by
it sorts by bucket. `write_buckets` stores sequences in a folder per bucket.

Ids are those of the tokenizers library. Most words of a text have been seen before, so each worker keeps
the ids of words it has met (a bounded table) and gives the library's model only those that are new. That
is done for ASCII and the letters of Latin-1, for which lower case and pre-tokens are simple; words with
other characters go through the whole library. No pre-token holds white space, so a text can be encoded in
sections that end at spaces, and long texts are.

Cases: a null or empty text has the end id only, one piece of length 1. Rows that repeat an id are
documents of their own. Text that spells a special token becomes that token's id, as the library does.
An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitelens.llm.bpe import byte_letters
from sitelens.llm.common import keeps_tables, others_forget

#: The longest sequence; a power of two.
LONGEST = 2048

#: Words, and pre-tokens of words, whose ids a worker remembers; longer ones are not remembered.
REMEMBERED, LONG_WORD = 800_000, 64

#: Characters after which a section of a text ends at the next space.
SECTION = 1 << 16

#: Characters other than those handled here: printable ASCII, its white space, letters of Latin-1.
_ODD = re.compile("[^\t-\r -~À-ÿ]")

#: Fixed value: the pre-token pattern, for lower-case text of the characters above. The two signs
#: among the letters of Latin-1 are no letters.
_PRE_TOKEN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|"
    r"[^\t-\r 0-9a-zß-öø-ÿ]+"
)

_SPACE = re.compile("[\t-\r ]+")

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class Encoder:
    """A tokenizer file; texts in, ids as packed 32-bit integers out."""

    def __init__(self, definition: str):
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # The model knows bytes by letters that stand for them.
        self.letters = {value: letter for letter, value in byte_letters().items()}
        self.pre_token = functools.lru_cache(REMEMBERED)(self._pre_token)
        # Ids by word. When the table is full it becomes the older one, and only what is met again
        # moves on.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _pre_token(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(word)]).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a lower-case word without odd characters."""
        if len(word) > LONG_WORD:
            return b"".join(map(self._pre_token, _PRE_TOKEN.findall(word)))
        return b"".join(map(self.pre_token, _PRE_TOKEN.findall(word)))

    def _simple(self, text: str) -> bytes:
        """The ids of a text without odd characters and special tokens."""
        words = text.lower().split()
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, long_ones = self.known, self.older, {}
        for word in set(words):
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    ids = self._word(word)
                (known if len(word) <= LONG_WORD else long_ones)[word] = ids
        if long_ones:
            return b"".join([long_ones[w] if w in long_ones else known[w] for w in words])
        return b"".join(map(known.__getitem__, words))

    def _section(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self._library(text)
        if not _ODD.search(text):
            return self._simple(text)
        out, plain = [], []
        for word in _SPACE.split(text):
            if not _ODD.search(word):
                plain.append(word)
                continue
            if plain:
                out.append(self._simple(" ".join(plain)))
                plain = []
            out.append(self._library(word))
        out.append(self._simple(" ".join(plain)))
        return b"".join(out)

    def encode(self, text: str) -> bytearray:
        ids = bytearray()
        for section in sections(text):
            ids += self._section(section)
        return ids


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """A text in parts that end before white space; a part without any stays whole."""
    begin = 0
    while len(text) - begin > size:
        space = _SPACE.search(text, begin + size)
        if space is None:
            break
        yield text[begin : space.start()]
        begin = space.start()
    yield text[begin:] if begin else text


@functools.lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


keeps_tables(__name__, encoder.cache_clear)


def lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """The lengths of the pieces of a document: powers of two that add up to its ids."""
    rest = tokens % longest
    digits = [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]
    return [longest] * (tokens // longest) + digits


#: A sequence's number from its bucket, partition and place: the first bits say the bucket, then
#: come 26 bits for the partition and 33 for the place.
_PLACE_BITS, _PARTITION_BITS = 33, 26


def sequence_number(length: int, partition: int, place: int) -> int:
    bucket = length.bit_length() - 1
    return ((bucket << _PARTITION_BITS) + partition << _PLACE_BITS) + place


def pack(
    rows: DataFrame,
    definition: str,
    end_id: int,
    *,
    longest: int = LONGEST,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.

    `definition` is the content of a tokenizer file (JSON) and `end_id` closes every document. A
    sequence holds one piece, so offset is 0 and length is the length of the sequence too.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence has to be a power of two")
    shipped = rows.sparkSession.sparkContext.broadcast(definition)
    closing = array("I", [end_id]).tobytes()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others_forget(__name__)
        tool = encoder(shipped.value)
        partition = TaskContext.get().partitionId()
        places: dict[int, int] = {}
        for batch in batches:
            found = _Pieces()
            for doc, text_ in zip(batch.column(0), batch.column(1), strict=True):
                ids = tool.encode(text_.as_py() or "")
                ids += closing
                start, all_ = 0, len(ids) // 4
                view = memoryview(ids)
                for length in lengths(all_, longest):
                    place = places.get(length, 0)
                    places[length] = place + 1
                    number = sequence_number(length, partition, place)
                    piece = bytes(view[4 * start : 4 * (start + length)])
                    found.add(doc.as_py(), start, length, piece, all_, number)
                    start += length
                if found.bytes > _BATCH_BYTES:
                    yield found.batch()
                    found = _Pieces()
            if found.rows:
                yield found.batch()

    chosen = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(apply, SCHEMA)


#: Bytes of ids after which a batch of pieces is handed on.
_BATCH_BYTES = 8 << 20


class _Pieces:
    """Pieces on their way to an Arrow batch."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc, start: int, length: int, ids: bytes, all_: int, number: int) -> None:
        self.rows.append((doc, start, length, ids, all_, number, 0))
        self.bytes += len(ids)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(x, k) for x, k in zip(zip(*self.rows, strict=True), kinds, strict=True)]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences as Parquet, one folder per length, so that a reader takes batches of
    equal length from one folder."""
    pieces.write.partitionBy("length").parquet(path)
