from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from merchlens.llm import fuzzy
from tests.llm import corpus


def levels(data: bytes) -> list[int]:
    """The rolling hash a byte at a time."""
    window, found = [0] * fuzzy.WINDOW, []
    for byte in data:
        window = window[1:] + [byte]
        spread = 0
        for w in window:
            spread = ((spread << 5) ^ w) & 0xFFFFFFFF
        value = (sum((i + 2) * w for i, w in enumerate(window)) + spread) & 0xFFFFFFFF
        level = -1
        if (value + 1) % 3 == 0:
            level = 0
            while (value + 1) % (3 << (level + 1)) == 0:
                level += 1
        found.append(level)
    return found


def distance(a: str, b: str) -> int:
    """Insertions and deletions from one to the other, by the full table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(above[j - 1] if x == y else 1 + min(above[j], row[-1]))
    return row[-1]


def test_cuts_equal_the_byte_by_byte_hash(monkeypatch):
    monkeypatch.setattr(fuzzy, "_CHUNK", 97)
    for text in corpus.texts():
        data = (text or "").encode()[:3000]
        assert fuzzy.cut_levels(data).tolist() == levels(data)
        assert fuzzy.cut_levels(data[40:], data[:40]).tolist() == levels(data)[40:]


def test_likeness_is_the_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 64)))
        b = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 64)))
        assert fuzzy._common(a, b) == (len(a) + len(b) - distance(a, b)) / 2


def test_block_sizes_have_to_be_compatible():
    long, half = "ABCDEFGH" * 4, "ABCDEFGH" * 2
    assert fuzzy.likeness(f"12:{long}:{half}", f"12:{long}:{half}") == 1
    assert fuzzy.likeness(f"12:{long}:{half}", f"24:{half}:ABCD") == 1
    assert fuzzy.likeness(f"24:{half}:ABCD", f"12:{long}:{half}") == 1
    assert fuzzy.likeness(f"12:{long}:{half}", f"48:{half}:ABCD") == 0
    assert fuzzy.likeness("3::", "3::") == 1


def test_near_texts_are_near_and_others_not():
    for seed in range(20):
        text = corpus.prose(seed, 400)
        print_ = fuzzy.fingerprint(text.encode())
        near = fuzzy.fingerprint(corpus.edited(text, seed, 3).encode())
        other = fuzzy.fingerprint(corpus.prose(seed + 100, 400).encode())
        assert fuzzy.likeness(print_, near) > 0.7 > 0.2 > fuzzy.likeness(print_, other)


def directly(rows: list[tuple]) -> Counter:
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [(r[0], r[1] or "") for r in ordered]
    found = Counter()
    for at, (doc_id, text) in enumerate(texts):
        follow = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        a, b, c = (fuzzy.fingerprint(t.encode()) for t in (text, edited, follow))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        found[
            (doc_id, len(text), digest, a, b, fuzzy.likeness(a, b), fuzzy.likeness(a, c))
        ] += 1
    return found


@pytest.mark.parametrize("buckets", [1, 4, 60])
def test_rows_equal_a_direct_pass(spark, buckets):
    docs = corpus.table(spark)
    got = fuzzy.edited_likeness(docs, buckets).collect()
    assert Counter(map(tuple, got)) == directly(corpus.rows())


def test_small_and_clashing_tables(spark):
    assert fuzzy.edited_likeness(corpus.table(spark, [])).collect() == []
    one = [corpus.rows()[0]]
    got = fuzzy.edited_likeness(corpus.table(spark, one)).collect()
    assert Counter(map(tuple, got)) == directly(one)
    docs = corpus.table(spark)
    assert corpus.bag(fuzzy.edited_likeness(corpus.clashing(docs))) == corpus.bag(
        fuzzy.edited_likeness(docs)
    )
