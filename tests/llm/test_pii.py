from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np

from merchlens.llm import pii
from tests.comparison import SAMPLE
from tests.llm import corpus


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def by_patterns(text: str) -> list[tuple[int, int, int]]:
    """The patterns as they are stated, matched by the regular expression engine alone."""
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    card = r"[0-9]([\x20-]?[0-9])+"
    phone = r"\+[0-9][\x20().0-9-]+[0-9]"
    found = [(0, *m.span()) for m in re.finditer(email, text)]
    found += [
        (1, *m.span())
        for m in re.finditer(ip, text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    for m in re.finditer(card, text):
        digits = re.sub(r"[\x20-]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in re.finditer(phone, text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((3, *m.span()))
    return found


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for text in [t or "" for t in corpus.texts()]:
        assert pii.base_spans(text) == by_patterns(text)
    for _ in range(20_000):
        text = "".join(rng.choice("aA1234567890@.@.+-( )%_é41") for _ in range(60))
        assert pii.base_spans(text) == by_patterns(text)


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " " * 300_000):
        pii.base_spans(run)
    assert pii.base_spans("9" * 5000 + ".1.1.1") == []


def sample() -> list[str]:
    rng = random.Random(8)
    texts = []
    for i in range(60):
        number = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        texts.append(
            f"call {number} or write u{i}@mail.example.com from 10.0.{i}.7 with "
            f"id {rng.randrange(10**15, 10**16)} on line {i}"
        )
    return texts


def test_message_passing_is_exact_on_a_tree():
    """Without loops, beliefs are the marginals of the joint distribution."""
    text = "x1 555-0147 then 555-0147 a2"
    tokens = pii.candidates(text, [])
    rng = np.random.default_rng(0)
    labels = len(pii.KINDS) + 1
    field = pii.Field(
        rng.normal(size=(pii._FEATURES, labels)),
        rng.normal(size=(labels, labels)),
        rng.normal(size=(labels, labels)),
    )
    chain, skip = pii._links(tokens)
    assert len(chain) + len(skip) == len(tokens) - 1
    local = pii._features(tokens) @ field.node
    joint = np.zeros([labels] * len(tokens))
    for index in np.ndindex(*joint.shape):
        score = sum(local[i, y] for i, y in enumerate(index))
        score += sum(field.chain[index[a], index[b]] for a, b in chain)
        score += sum(field.skip[index[a], index[b]] for a, b in skip)
        joint[index] = np.exp(score)
    joint /= joint.sum()
    belief = field.beliefs(tokens, rounds=500)
    for i in range(len(tokens)):
        others = tuple(k for k in range(len(tokens)) if k != i)
        assert np.allclose(belief[i], joint.sum(axis=others), atol=1e-3)


def test_evidence_crosses_a_long_document():
    labels = len(pii.KINDS) + 1
    node = np.zeros((pii._FEATURES, labels))
    node[1 + labels - 1, labels - 1] = 20
    field = pii.Field(node, np.zeros((labels, labels)), 20 * np.eye(labels))
    text = "+12125550147 " + "x 2125550147 " * 500
    tokens = pii.candidates(text, pii.base_spans(text))
    assert len(tokens) == 501
    assert (field.beliefs(tokens).argmax(axis=1) == labels - 1).all()
    assert np.allclose(field.beliefs(tokens), field.beliefs(tokens, rounds=10_000), atol=1e-3)


def test_repeats_take_the_label_of_the_match():
    field = pii.train(sample())
    text = "call +1 (212) 555-0147 today. later 212-555-0147 again, order 1234567 stays"
    base, every = pii.all_spans(text, field)
    added = [text[s:e] for k, s, e in every if (k, s, e) not in base]
    assert added == ["212-555-0147"] and set(base) <= set(every)
    card = "pay 4111111111111111 today. 5500005555555559 4111111111111111 x"
    base, every = pii.all_spans(card, field)
    assert len(base) == 1 and len(every) == 2


def test_numbers_in_groups_are_linked_and_backed():
    field = pii.train(sample())
    for first, later in (
        ("+44 20 7946 0958", "020 7946 0958"),
        ("+442079460958", "020 7946 0958"),
        ("+44 20 7946 0958", "02079460958"),
        ("+33 1 42 68 53 00", "01 42 68 53 00"),
        ("+49 30 123456", "030 123456"),
    ):
        text = f"call {first} today. later {later} again, 12 times in 2024 and 7946 more"
        base, every = pii.all_spans(text, field)
        assert [text[s:e] for _, s, e in base] == [first]
        assert [text[s:e] for k, s, e in every if (k, s, e) not in base] == [later], first
        assert later not in pii.masked(text, field)


def test_equal_tokens_are_linked():
    tokens = pii.candidates("x 7946 and 12 or 7946 but 7946", [])
    assert [t.text for t in tokens] == ["7946", "12", "7946", "7946"]
    assert pii._links(tokens)[1].tolist() == [[0, 2], [2, 3]]


def test_clean_texts_stay_clean():
    field = pii.train(sample())
    for text in ("no numbers here", "12 apples, 3.5 kg, 2024-01-01, 1234567 and 1234567", "a@b"):
        assert pii.all_spans(text, field) == ([], [])


def test_table_results(spark):
    docs = corpus.table(spark)
    field = pii.train(sample())
    got = pii.personal_data(docs, field).collect()
    assert len(got) == len(corpus.rows())
    texts = {}
    for row in corpus.rows():
        texts.setdefault(row[0], []).append(row[1] or "")
    for r in got:
        digests = {
            hashlib.sha256(pii.written(by_patterns(t)).encode()).hexdigest()
            for t in texts[r.doc_id]
        }
        assert r.base_sha256 in digests
    long = next(r for r in got if r.n_email)
    assert (long.n_email, long.n_ip, long.n_card, long.n_phone) == (3, 3, 3, 3)
    assert corpus.bag(pii.personal_data(corpus.clashing(docs), field)) == corpus.bag(
        pii.personal_data(docs, field)
    )


def test_fit_on_a_table_and_on_none(spark):
    docs = spark.createDataFrame(list(enumerate(sample())), "doc_id bigint, text string")
    first, again = pii.fit(docs), pii.fit(docs.repartition(5))
    assert np.allclose(first.node, again.node) and np.allclose(first.skip, again.skip)
    empty = corpus.table(spark, [])
    assert pii.personal_data(empty).collect() == []


def test_the_sample_is_cut_before_it_is_collected(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 80)
    rows = [(i // 50, f"{text} {i}") for i, text in enumerate(sample() * 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    held, collect = [], type(docs).collect

    def counted(frame):
        held.append(collect(frame))
        return held[-1]

    monkeypatch.setattr(type(docs), "collect", counted)
    pii.fit(docs)
    assert max(map(len, held)) == 80


def test_masking_keeps_rows_and_counts(spark):
    docs = corpus.table(spark)
    field = pii.train(sample())
    masked = pii.with_masked_text(docs, field)
    assert masked.columns == docs.columns
    rows = masked.collect()
    assert len(rows) == len(corpus.rows())
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows)
    assert not any(pii.base_spans(r.text or "") for r in rows)
    assert sum("<email>" in (r.text or "") for r in rows) == 1


WAYS = {
    "dashes": lambda d: f"{d[:3]}-{d[3:6]}-{d[6:]}",
    "brackets": lambda d: f"({d[:3]}) {d[3:6]}-{d[6:]}",
    "blanks": lambda d: f"{d[:3]} {d[3:6]} {d[6:]}",
    "dots": lambda d: f"{d[:3]}.{d[3:6]}.{d[6:]}",
    "in one": lambda d: d,
    "the last seven": lambda d: f"{d[3:6]}-{d[6:]}",
    "pairs": lambda d: " ".join(d[i : i + 2] for i in range(0, 10, 2)),
}


def test_planted_repeats_are_found_by_the_field_itself(spark):
    """Numbers of the sample written again without prefix, and others that repeat nothing.

    Recall and precision of the field, of the field without the rule that a label needs a
    similar match, and of the field without the set agreement, which finds none.
    """
    docs = spark.read.parquet(f"{SAMPLE}/sf0.01/documents.parquet").where("text IS NOT NULL")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    field = pii.train([e for e in map(pii.excerpt, texts) if e])
    agreeing = pii.AGREEMENT * np.diag([0] + [1] * len(pii.KINDS))
    learned_only = replace(field, skip=field.skip - agreeing)

    def without_rule(own, text):
        tokens = pii.candidates(text, pii.base_spans(text))
        belief = own.beliefs(tokens)
        return [
            (int(b.argmax()) - 1, t.start, t.end)
            for t, b in zip(tokens, belief)
            if b.argmax() and b.max() >= pii.SURE and not t.label
        ]

    finders = {
        "field": lambda text: field.added(text, pii.base_spans(text)),
        "without rule": lambda text: without_rule(field, text),
        "learned only": lambda text: without_rule(learned_only, text),
    }
    rng = random.Random(4)
    found, wrong, planted = Counter(), Counter(), 0
    for text in texts:
        phones = [text[a:b] for kind, a, b in pii.base_spans(text) if kind == 3]
        digits = pii._digits(phones[0])[-10:] if phones else ""
        if len(digits) < 10:
            continue
        other = "".join(rng.choice("0123456789") for _ in range(10))
        for way in WAYS.values():
            planted += 1
            for name, find in finders.items():
                again = f"{text}\nCall again: {way(digits)} today"
                numbers = [i for i in range(len(text) + 12, len(again)) if again[i].isdigit()]
                covered = {i for _, a, b in find(again) for i in range(a, b)}
                found[name] += covered.issuperset(numbers)
                unrelated = f"{text}\nOrder number {way(other)} went out"
                wrong[name] += any(b > len(text) for _, _, b in find(unrelated))
    assert planted >= 50
    for name in ("field", "without rule"):
        assert found[name] >= 0.9 * planted and wrong[name] <= 0.01 * planted, (name, found, wrong)
    assert found["learned only"] < 0.5 * planted
