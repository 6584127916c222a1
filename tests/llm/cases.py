"""Documents with everything that can go wrong, and small helpers."""

import random
import zlib

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Names that operators use themselves.
    " score double, kept string, words string, key string, hash string, uses string, spans string"
)


def rng(seed):
    return random.Random(seed)


def prose(seed, n):
    r = rng(seed)
    syllables = "the re in ing ed st an or tion ly ou ha wh".split()
    words = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n)]
    return " ".join(words) + "."


def texts():
    long_ = prose(1, 30_000)
    base = prose(2, 200)
    near = base.replace(base.split()[100], "changed", 1)
    return [
        (1, base, "en", "a"),
        (2, near, "en", "a"),
        (3, base, None, "b"),
        (4, None, "en", "a"),
        (5, "", "en", None),
        (6, " \t\n\r\x0b\x0c ", "en", "a"),
        (7, long_, "en", "hot"),
        (8, "x" * 20_000, None, "hot"),
        (9, "é" * 7 + "🙂\n\n" + "中文 字", "fr", "hot"),
        (10, "line one\nline one\nline two\n" * 40, "en", "hot"),
        (11, "one two three four", "en", "hot"),
        (12, "one two three four", "en", "hot"),
        (12, "one two three four", "en", "hot"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (13, "password = hunter2hunter2 mail a.b@c.de 10.0.0.1", "en", "a"),
        (14, "!! ## $$ %%%", "en", "c"),
        (15, "\u0000a b <|endoftext|> 's 12   end  ", "en", "c"),
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [
            (i, t, lang, source, None if t is None else len(t), 9.0, "k", "w", "y", "h", "u", "s")
            for i, t, lang, source in rows
        ],
        COLUMNS,
    )


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def crc(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def words(text):
    return [] if text is None else text.encode().split()
