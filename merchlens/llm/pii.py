"""Personal data: exact patterns, and a skip-chain conditional random field on top.

The patterns find emails, IP addresses, card and phone numbers. The field then labels
every token that holds a digit or an at sign: neighbours share chain potentials, and
tokens that repeat or resemble each other anywhere in the document share skip
potentials. Loopy sum-product passing makes their labels agree, so a number found
once in full is also found where it is repeated without its prefix. All other tokens
are fixed to no label, which cuts the chain and leaves few nodes. Repeats are linked
each to the next, so links grow with the tokens and not with their pairs.

Tokens repeat when their texts are equal. They resemble each other when they are parts
of numbers that end in the same seven digits or more, whether written in one token or
in groups parted by single blanks, or addresses that differ in case only.

Weights are trained on a bounded sample of documents whose labels are the pattern
matches. The match itself is a feature that is hidden from half of the tokens, so
that shape, neighbours and repeats have to explain labels too.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import documents, in_slices, per_batch

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")

# Bounds of the training sample: documents, by smallest hash of their doc_id, labelled
# tokens of each, and characters of a token with its surroundings.
SAMPLE_DOCS, SAMPLE_TOKENS, SAMPLE_CHARS = 4000, 400, 400

# A token gets a label that no pattern gave it only when this sure.
SURE = 0.7

# Added to the learned potential of two similar tokens that share a kind: patterns
# label nearly all repeats alike, so the sample has few cases to learn it from. What it
# brings is measured on planted repeats in the tests: without it few are found.
AGREEMENT = 8.0

_HINT = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
# A match cannot begin inside a run of digits: it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LABELS = len(KINDS) + 1


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and _luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every pattern match, in linear time, by kind and start.

    Emails are found from their at signs: the local part is the run of its characters
    to the left, back to the match before, which is where a leftmost match begins.
    """
    if not _HINT.search(text):
        return []
    found, taken = [], 0
    for domain in _DOMAIN.finditer(text):
        at = start = domain.start()
        while start > taken and not _LOCAL_END.match(text, start - 1):
            start -= 1
        if start < at:
            found.append((0, start, domain.end()))
            taken = domain.end()
    found += [(1, *m.span()) for m in _IP.finditer(text) if _is_ip(m.group())]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if _is_card(m.group())]
    found += [
        (3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15
    ]
    return found


# ---- tokens and features ------------------------------------------------------

_SPACE = " \t\n\x0b\x0c\r"
_TRIM = ".,;:!?\"'<>[]{}"


@dataclass(frozen=True)
class Token:
    start: int
    end: int
    text: str
    label: int  # 1 + kind of the match over it, or 0
    joined: bool  # only one blank parts it from the token before


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[Token]:
    """Tokens with a digit or an at sign, trimmed of punctuation, in order."""
    spans = sorted((start, end, kind) for kind, start, end in base)
    tokens, done, at, before = [], 0, 0, -2
    for hint in _HINT.finditer(text):
        if hint.start() < done:
            continue
        start = hint.start()
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        end = hint.end()
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        done, raw = end, text[start:end]
        core = raw.strip(_TRIM)
        begin = start + len(raw) - len(raw.lstrip(_TRIM))
        while at < len(spans) and spans[at][1] <= begin:
            at += 1
        label, over = 0, at
        while not label and over < len(spans) and spans[over][0] < begin + len(core):
            label = spans[over][2] + 1 if spans[over][1] > begin else 0
            over += 1
        tokens.append(Token(begin, begin + len(core), core, label, start - before == 1))
        before = end
    return tokens


# Digits at the end of a number by which it is known: at least, and at most.
_LEAST, _MOST = 7, 15


def _parts(tokens: list[Token]) -> list[tuple[str, list[int]]]:
    """Number endings and addresses, each with the tokens it is written in.

    A number goes on over single blanks, and may end at any of its tokens. A token is a
    part of an ending that has two of its digits, or all but zeros it begins with.
    """
    digits = [_digits(token.text) for token in tokens]
    plain = [not any(c == "@" or c.isalpha() for c in token.text) for token in tokens]
    found: list[tuple[str, list[int]]] = []
    for end, token in enumerate(tokens):
        if "@" in token.text:
            found.append((token.text.lower(), [end]))
            continue
        first, number, after = end, digits[end], [0]
        while (
            len(number) < _MOST
            and first
            and plain[first]
            and plain[first - 1]
            and tokens[first].start - tokens[first - 1].end == 1
        ):
            after.append(len(number))
            first -= 1
            number = digits[first] + number
        for length in range(_LEAST, min(_MOST, len(number)) + 1):
            inside = [
                end - back
                for back, skipped in enumerate(after)
                if length - skipped >= min(2, len(digits[end - back].lstrip("0")) or 1)
            ]
            found.append((number[-length:], inside))
    return found


_SHAPES = (
    lambda t, d: "@" in t,
    lambda t, d: "@" in t and bool(_DOMAIN.search(t)) and not t.startswith("@"),
    lambda t, d: "@" not in t and 16 <= len(d) <= 19 and _luhn(d),
    lambda t, d: "@" not in t and 16 <= len(d) <= 19 and not _luhn(d),
    lambda t, d: len(d) > 19,
    lambda t, d: 8 <= len(d) <= 15,
    lambda t, d: 4 <= len(d) <= 7,
    lambda t, d: 1 <= len(d) <= 3,
    lambda t, d: bool(_IP.fullmatch(t)) and _is_ip(t),
    lambda t, d: bool(_IP.fullmatch(t)) and not _is_ip(t),
    lambda t, d: t.startswith("+"),
    lambda t, d: "(" in t or ")" in t,
    lambda t, d: bool(re.fullmatch(r"[0-9]{3,4}-[0-9]{3,4}", t)),
    lambda t, d: any(c.isalpha() for c in t) and "@" not in t,
)
_FEATURES = 1 + _LABELS + len(_SHAPES)


def _features(tokens: list[Token]) -> np.ndarray:
    """Constant, one-hot label of the pattern over the token, shapes."""
    made = np.zeros((len(tokens), _FEATURES))
    for row, token in zip(made, tokens):
        digits = _digits(token.text)
        row[0] = 1
        row[1 + token.label] = 1
        row[1 + _LABELS :] = [shape(token.text, digits) for shape in _SHAPES]
    return made


def _links(
    tokens: list[Token], parts: list[tuple[str, list[int]]] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Chain links (i, i + 1), and skip links from each token to the next like it."""
    chain = [(i - 1, i) for i, token in enumerate(tokens) if i and token.joined]
    written_in: dict[tuple[str, str], list[list[int]]] = {}
    for i, token in enumerate(tokens):
        written_in.setdefault(("text", token.text), []).append([i])
    for key, inside in _parts(tokens) if parts is None else parts:
        written_in.setdefault(("part", key), []).append(inside)
    skip = set()
    for places in written_in.values():
        if len(places) > 1:
            like = sorted({i for inside in places for i in inside})
            skip.update(zip(like[:-1], like[1:]))
    shape = (-1, 2)
    return np.array(chain, int).reshape(shape), np.array(sorted(skip), int).reshape(shape)


# ---- the field -------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Weights: features by label, label after label, and label with a similar token's."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, tokens: list[Token], rounds: int | None = None) -> np.ndarray:
        """Label probabilities by loopy sum-product, until messages settle.

        A message takes about two damped rounds a link, so that by default there are
        rounds enough to cross all tokens there and back.
        """
        rounds = rounds or max(200, 4 * len(tokens))
        local = np.exp(_scaled(_features(tokens) @ self.node))
        chain, skip = _links(tokens)
        forward = np.concatenate([chain, skip])
        source = np.concatenate([forward[:, 0], forward[:, 1]])
        target = np.concatenate([forward[:, 1], forward[:, 0]])
        kinds = [self.chain] * len(chain) + [self.skip] * len(skip)
        pair = np.exp(np.array([*kinds, *(k.T for k in kinds)]).reshape(-1, _LABELS, _LABELS))
        back = (np.arange(len(source)) + len(forward)) % max(1, len(source))
        sent = np.full((len(source), _LABELS), 1 / _LABELS)
        for _ in range(rounds):
            total = np.log(local)
            np.add.at(total, target, np.log(sent))
            ahead = np.exp(_scaled(total[source] - np.log(sent[back])))
            new = np.einsum("ea,eab->eb", ahead, pair)
            new /= new.sum(axis=1, keepdims=True)
            new = np.maximum(0.5 * (new + sent), 1e-30)
            settled = not len(new) or np.abs(new - sent).max() < 1e-4
            sent = new
            if settled:
                break
        total = np.log(local)
        np.add.at(total, target, np.log(sent))
        belief = np.exp(_scaled(total))
        return belief / belief.sum(axis=1, keepdims=True)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of labelled tokens that no pattern matched; neighbours make one span.

        A document without any match has nothing to be consistent with.
        """
        tokens = candidates(text, base) if base else []
        if all(token.label for token in tokens):
            return []
        parts = _parts(tokens)
        held = {(key, tokens[i].label) for key, inside in parts for i in inside}
        belief = self.beliefs(tokens)
        best = belief.argmax(axis=1)
        best[belief.max(axis=1) < SURE] = 0
        # A label has to come from a similar token's match, or from a neighbour that has it so.
        backed = [False] * len(tokens)
        for key, inside in parts:
            for i in inside:
                backed[i] = backed[i] or (best[i] > 0 and (key, int(best[i])) in held)
        ahead = range(1, len(tokens))
        for i, j in [*((i - 1, i) for i in ahead), *((i, i - 1) for i in reversed(ahead))]:
            joined = tokens[max(i, j)].joined and best[i] == best[j] and not tokens[i].label
            backed[j] = backed[j] or (joined and backed[i])
        best[~np.array(backed)] = 0
        spans: list[tuple[int, int, int]] = []
        open_kind = -1
        for token, label in zip(tokens, best):
            kind = int(label) - 1 if not token.label else -1
            if kind >= 0 and kind == open_kind and token.joined:
                spans[-1] = (kind, spans[-1][1], token.end)
            elif kind >= 0:
                spans.append((kind, token.start, token.end))
            open_kind = kind
        return spans


def _scaled(scores: np.ndarray) -> np.ndarray:
    return scores - scores.max(axis=-1, keepdims=True) if scores.size else scores


def train(documents_: list[str], steps: int = 400, rate: float = 0.3, decay: float = 0.1) -> Field:
    """Pseudo-likelihood by gradient ascent: each label given features and linked labels."""
    rows, labels = [], []
    for text in documents_:
        tokens = candidates(text, base_spans(text))[:SAMPLE_TOKENS]
        if not tokens:
            continue
        features = _features(tokens)
        features[1::2, 1 : 1 + _LABELS] = 0
        truth = np.array([t.label for t in tokens])
        onehot = np.eye(_LABELS)[truth]
        near = [np.zeros((len(tokens), _LABELS)) for _ in range(3)]
        chain, skip = _links(tokens)
        np.add.at(near[0], chain[:, 1], onehot[chain[:, 0]])
        np.add.at(near[1], chain[:, 0], onehot[chain[:, 1]])
        np.add.at(near[2], skip[:, 1], onehot[skip[:, 0]])
        np.add.at(near[2], skip[:, 0], onehot[skip[:, 1]])
        rows.append(np.concatenate([features, *near], axis=1))
        labels.append(truth)
    width = _FEATURES + 3 * _LABELS
    x = np.concatenate(rows) if rows else np.zeros((1, width))
    y = np.eye(_LABELS)[np.concatenate(labels)] if rows else np.eye(_LABELS)[[0]]
    weights = np.zeros((width, _LABELS))
    seen = np.full_like(weights, 1e-8)
    for _ in range(steps):
        odds = np.exp(_scaled(x @ weights))
        odds /= odds.sum(axis=1, keepdims=True)
        slope = x.T @ (y - odds) - decay * weights
        # Steps shrink with the slopes met so far, so rare features move as far as common ones.
        seen += slope**2
        weights = weights + rate * slope / np.sqrt(seen)
    before, after, similar = np.split(weights[_FEATURES:], 3)
    agreeing = AGREEMENT * np.diag([0] + [1] * len(KINDS))
    return Field(
        weights[:_FEATURES], (before + after.T) / 2, (similar + similar.T) / 2 + agreeing
    )


def fit(docs: DataFrame) -> Field:
    """A field trained on rows of the documents with the smallest hashes of doc_id.

    At most `SAMPLE_DOCS` rows come to the driver, however often a doc_id is repeated,
    and of each only the neighbourhoods of its first `SAMPLE_TOKENS` tokens with a digit
    or an at sign, without those longer than `SAMPLE_CHARS`. More are cut by the hash of
    doc_id and neighbourhoods. Which rows are sampled follows the number of ids; all rows
    are searched for personal data whatever the sample. A table without personal data gives
    a field that adds none.
    """
    ids = docs.select("doc_id", F.xxhash64("doc_id").alias("place")).where("doc_id IS NOT NULL")
    held = ids.agg(F.approx_count_distinct("place")).first()[0]
    if held > 4 * SAMPLE_DOCS:
        # About twice the sample has so small a hash: that many ids are sorted, not all.
        ids = ids.where(F.col("place") < int(-(2**63) + 2 * SAMPLE_DOCS / held * 2**64))
    found = ids.distinct().orderBy("place", "doc_id").limit(SAMPLE_DOCS).collect()
    chosen = sorted({row.doc_id for row in found})

    def step(doc_id, texts):
        kept = [excerpt(text or "") for text in texts]
        rows = [(i, text) for i, text in zip(doc_id, kept) if text]
        return [[i for i, _ in rows], [text for _, text in rows]]

    some = docs.where(F.col("doc_id").isin(chosen))
    rows = per_batch(some, ["doc_id", "text"], step, "doc_id bigint, text string")
    few = rows.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE_DOCS)
    texts = sorted((row.doc_id, row.text) for row in few.collect())
    return train([text for _, text in texts])


def excerpt(text: str, around: int = 24) -> str:
    """The surroundings of the first tokens with a digit or an at sign, one a line."""
    parts: list[list[int]] = []
    for token in candidates(text, [])[:SAMPLE_TOKENS]:
        start, end = max(0, token.start - around), min(len(text), token.end + around)
        if end - start > SAMPLE_CHARS:
            continue
        if parts and start <= parts[-1][1]:
            parts[-1][1] = end
        else:
            parts.append([start, end])
    return "\n\n".join(text[start:end] for start, end in parts)


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """The pattern spans, and these with the added ones, both by kind and start."""
    base = base_spans(text)
    return base, sorted({*base, *field.added(text, base)})


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


@lru_cache(maxsize=2)
def _field(packed: bytes) -> Field:
    cut = np.frombuffer(packed).reshape(-1, _LABELS)
    return Field(cut[:_FEATURES], cut[_FEATURES:-_LABELS], cut[-_LABELS:])


def _packed(field: Field) -> bytes:
    return np.concatenate([field.node, field.chain, field.skip]).tobytes()


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, pattern matches by kind, SHA-256 of the matches, and all spans.

    Spans are kind:start:end in code points, end exclusive. One row per row of `docs`;
    a null text counts as empty and has no spans; equal texts have equal spans. Other
    columns are ignored. Without a field given, jobs fit one while the frame is built.
    """
    packed = _packed(field or fit(docs))

    def step(doc_id, texts):
        made = [all_spans(text or "", _field(packed)) for text in texts]
        counts = [[sum(s[0] == k for s in base) for base, _ in made] for k in range(len(KINDS))]
        digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in made]
        return [doc_id, *counts, digests, [written(every) for _, every in made]]

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    schema = f"doc_id bigint, {counts}, base_sha256 string, spans string"
    return per_batch(docs, ["doc_id", "text"], step, schema)


def masked(text: str | None, field: Field) -> str | None:
    """The text with every span replaced by its kind in angle brackets.

    Of overlapping spans the one that starts first, then the longest, names the kind;
    all characters under any of them go.
    """
    if text is None:
        return None
    _, spans = all_spans(text, field)
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts.append(text[done:start] + f"<{KINDS[kind]}>")
        done = max(done, end)
    return "".join(parts) + text[done:]


def with_masked_text(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """`docs` with personal data masked in `text` and `n_chars` counted anew.

    All columns and rows stay; null texts stay null with the n_chars they had. Without a
    field given, jobs fit one while the frame is built.
    """
    packed = _packed(field or fit(docs))

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        return in_slices(lambda part: [masked(t, _field(packed)) for t in part], pa.string(), texts)

    hidden = docs.withColumn("text", mask("text"))
    return hidden.withColumn(
        "n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    )


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return personal_data(documents(spark, sf_dir))
