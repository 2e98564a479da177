"""Small tables with the awkward rows that every corpus operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Columns that operators make or use themselves; inputs may have their own.
CLASHES = (
    "size shard slot bucket amount start failures measured row n_words word_chars set_id "
    "n_shingles component_id kept_id runs turn block words source_index target placed copy "
    "hashes part ids decoded text_hash page sha256 owner"
).split()


def prose(seed: int, words: int) -> str:
    """Words and lines without repeats of note, as a seed gives them."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnop"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + 12]) for i in range(0, words, 12))


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def texts() -> list[str | None]:
    base = [prose(i, 80 + 7 * i) for i in range(12)]
    near = [edited(base[i % 4], 100 + i, 1 + i % 3) for i in range(12)]
    return [
        *base,
        *near,
        base[0],
        base[0],
        base[5],
        None,
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "one two three four",
        "one two three four",
        "Ünïcödé ßtraße ÉCOLE\x1cjoin\x85ed\xa0words日本 " * 20,
        "same same same " * 60,
        "## && ** %% " * 40,
        "A LOUD TEXT! " * 40,
        prose(33, 100).upper(),
        "line of text\n" * 30,
        prose(77, 6000),
        "x" * 5000,
        "mail a.b@c.example.org or +1 (212) 555-0147, 10.0.0.1, 4111 1111 1111 1111. " * 3
        + "later 212-555-0147 again",
    ]


def rows() -> list[tuple]:
    sources = ["web", "books", None, "code", ""]
    made = [
        (i, text, "en", sources[i % 5 if i % 2 else 0], len(text) if text is not None else None)
        for i, text in enumerate(texts())
    ]
    # A row twice, a doc_id with two texts, and rows without doc_id.
    return [
        *made,
        made[3],
        (7, "another text under a doc_id that is taken", None, None, 41),
        (None, prose(5, 115), "en", "web", 800),
        (None, None, None, None, None),
    ]


def table(spark, chosen=None):
    return spark.createDataFrame(rows() if chosen is None else chosen, SCHEMA).repartition(3)


def clashing(docs):
    """The same rows with further columns of other types under names that operators use."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("own").alias(name) for name in CLASHES))


def bag(frame) -> list:
    return sorted(map(repr, frame.collect()))
