"""Byte-pair encoding and decoding of whole texts over a trie of distinct words.

Every prefix of a word has one encoding, and that encoding is the one of a shorter
prefix followed by one last token. So a trie node needs one state, the last token
of the prefix it stands for, and shared prefixes are encoded once. A word's tokens
are read off backwards: last token, the node before it, and so on.

The trie is kept in depth-first order: distinct words are sorted, and a word adds
the nodes below the longest prefix it shares with the word before it, whose states
are still on the path.

Whether a token may follow another is decided from the merges alone: the tokens
that stand at the seam while both sides are built must never merge across it.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from merchlens.llm.common import BATCH_ROWS, documents, find_package, give_back, slices

# Characters of text whose distinct words go into one trie, and pairs of tokens whose seams
# one Python worker remembers. They bound memory, not results.
TRIE_CHARS = 8_000_000
REMEMBERED_SEAMS = 60_000

# Texts with none of these, in lower case as well, are cleaned and split here: NFC keeps
# characters below U+0250 as they are, and Python's lower case and letter classes are the
# file's. All others go through the library's own normalizer and splitter; some capitals
# below U+0250 are among them, as their small letters lie above.
_UNUSUAL = re.compile("[\x00\x01\x1c-\x1f\x85\xa0\u0250-\U0010ffff]")
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\x20\\x09-\\x0D{_LETTERS}{_NUMBERS}]+"
)
# Marks of words given in byte letters already, and of special strings.
_MAPPED, _SPECIAL = "\x00", "\x01"
_NEVER = 1 << 60


def _letter_table() -> list[str]:
    """Letter of each byte: printable ones stand for themselves, others follow U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_TABLE = _letter_table()


def _byte_letters(word: str) -> str:
    return "".join([_TABLE[b] for b in word.encode()])


class Merges:
    """Ranks, spines and pairs of a vocabulary whose merges make one token each."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.rank = {}
        self.parts = {}
        own = {token: token for token in vocab}  # one string for each, however often it is read
        for at, (left, right) in enumerate(merges):
            pair = own.get(left, left), own.get(right, right)
            self.rank.setdefault(pair, at)
            self.parts.setdefault(own.get(left + right, left + right), pair)
        # A spine lists the tokens at one edge of a token, with the rank that ends each.
        self.right_spine: dict[str, list[tuple[str, int]]] = {}
        self.left_spine: dict[str, list[tuple[str, int]]] = {}
        self.seams: dict[tuple[str, str], bool] = {}
        # A token whose own characters are encoded otherwise never appears.
        self.reachable: dict[str, bool] = {}
        self.vocab = {token: number for token, number in vocab.items() if self._reaches(token)}
        # Few tokens meet in texts; their spines are made again when they do.
        self.forget()
        # By its last two letters: length of the longest token inside a word, and at its end.
        self.inside: dict[str, int] = {}
        self.ending: dict[str, int] = {}
        for token in self.vocab:
            at_end = suffix and token.endswith(suffix)
            letters = token[: -len(suffix)] if at_end else token
            longest = self.ending if at_end or not suffix else self.inside
            longest[letters[-2:]] = max(len(letters), longest.get(letters[-2:], 1))
        if not suffix:
            self.inside = self.ending

    def forget(self) -> None:
        for known in (self.seams, self.reachable, self.left_spine, self.right_spine):
            known.clear()

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        known = self.left_spine if side == 0 else self.right_spine
        if token not in known:
            if token not in self.parts:
                known[token] = [(token, _NEVER)]
            else:
                pair = self.parts[token]
                below = self._spine(pair[side], side)
                known[token] = [*below[:-1], (below[-1][0], self.rank[pair]), (token, _NEVER)]
        return known[token]

    def _reaches(self, token: str) -> bool:
        if token not in self.reachable:
            pair = self.parts.get(token)
            self.reachable[token] = pair is None or (
                self._reaches(pair[0])
                and self._reaches(pair[1])
                and self._apart(*pair, self.rank[pair])
            )
        return self.reachable[token]

    def _apart(self, left: str, right: str, until: int) -> bool:
        """No merge crosses the seam before rank `until`.

        At equal rank merges run from left to right: the left side's own goes first,
        and the one across the seam goes before the right side's own.
        """
        ours, theirs = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        since = -1
        while True:
            a, a_ends = ours[i]
            b, b_ends = theirs[j]
            rank = self.rank.get((a, b), _NEVER)
            if since <= rank < a_ends and rank <= b_ends and rank < until:
                return False
            since = min(a_ends, b_ends)
            if since >= until:
                return True
            if a_ends <= b_ends:
                i += 1
                if a_ends == b_ends:
                    # Both sides apply the same merge; the left side's comes first.
                    continue
            else:
                j += 1

    def encode(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word in byte letters, shared prefixes once."""
        vocab, suffix, seams = self.vocab, self.suffix, self.seams
        if len(seams) > REMEMBERED_SEAMS:
            self.forget()
        before, path = "", [""]  # path[d]: last token of the prefix of length d
        made = {}
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            size = len(word)
            # The end of the word is part of its last letter: an edge of its own.
            for end in range(len(path), size + 1):
                ending = suffix if end == size else ""
                known = self.ending if end == size else self.inside
                longest = known.get(word[max(0, end - 2) : end], 1)
                for start in range(max(0, end - longest), end):
                    token = word[start:end] + ending
                    if token in vocab:
                        if not start:
                            break
                        pair = (path[start], token)
                        apart = seams.get(pair)
                        if apart is None:
                            apart = seams[pair] = self._apart(*pair, _NEVER)
                        if apart:
                            break
                else:
                    raise ValueError(f"no token ends at {end} of {word!r}")
                if not ending:
                    path.append(token)
            end, tokens = size - len(token) + len(suffix), [token]
            while end > 0:
                token = path[end]
                tokens.append(token)
                end -= len(token)
            made[word] = tokens[::-1]
            before = word[: len(path) - 1]
        return made


class Codec:
    """Encoder of one tokenizer file: special strings, clean-up, words, tokens."""

    def __init__(self, content: str):
        parsed = json.loads(content)
        model = parsed["model"]
        # The library cleans and splits some texts; it never merges, and needs no vocabulary.
        bare = {**model, "vocab": {}, "merges": []}
        self.library = Tokenizer.from_str(json.dumps({**parsed, "model": bare, "added_tokens": []}))
        self.merges = Merges(
            model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"]
        )
        for token in parsed["added_tokens"]:
            if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"special string {token['content']!r} is not matched as it stands")
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        ordered = sorted(self.specials, key=len, reverse=True)
        # Without special strings nothing matches.
        self.special = re.compile("(" + ("|".join(map(re.escape, ordered)) or "(?!)") + ")")
        # Words of the last texts, marked if mapped or special -> their ids as packed int32.
        self.known: dict[str, bytes] = {}
        names = {number: token for token, number in model["vocab"].items()}
        names |= {number: name for name, number in self.specials.items()}
        self.names = [names.get(number, "") for number in range(max(names) + 1)]
        self.digits = [str(number) for number in range(len(self.names))]

    def _plain_words(self, text: str) -> list[str]:
        lowered = text.lower()
        if not _UNUSUAL.search(text) and not _UNUSUAL.search(lowered):
            return _WORDS.findall(lowered)
        clean = self.library.normalizer.normalize_str(text)
        return [_MAPPED + word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def words(self, text: str) -> list[str]:
        """Special strings, and words of the cleaned text between them."""
        if not any(name in text for name in self.specials):
            return self._plain_words(text)
        found = []
        for at, piece in enumerate(self.special.split(text)):
            found += [_SPECIAL + piece] if at % 2 else self._plain_words(piece)
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Make these the known words, all that were not known encoded in one trie."""
        before, known, spelt = self.known, {}, {}
        for word in words:
            if word in before:
                known[word] = before[word]
            elif word[0] == _SPECIAL:
                known[word] = np.int32(self.specials[word[1:]]).tobytes()
            elif word[0] == _MAPPED:
                spelt[word] = word[1:]
            else:
                plain = word.isascii() and word.isprintable()
                spelt[word] = word if plain else _byte_letters(word)
        self.known = known
        del before
        encoded = self.merges.encode(set(spelt.values()))
        vocab = self.merges.vocab
        for word, letters in spelt.items():
            known[word] = array("i", [vocab[token] for token in encoded[letters]]).tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text. Words are numbered, so a text waits as one number a word."""
        texts = iter(texts)
        while True:
            numbers: defaultdict[str, int] = defaultdict(count().__next__)
            size, rows = 0, []
            for text in texts:
                rows.append(array("I", map(numbers.__getitem__, self.words(text or ""))))
                size += len(text or "")
                if size >= TRIE_CHARS:
                    break
            if not rows:
                return
            self.learn(numbers)
            ids = [self.known[word] for word in numbers]
            for row in rows:
                yield np.frombuffer(b"".join([ids[number] for number in row]), np.int32)

    def forget(self) -> None:
        self.known = {}
        self.merges.forget()

    def written(self, ids: np.ndarray) -> str:
        """Ids in decimal, joined by blanks."""
        digits = self.digits
        return " ".join([digits[i] for i in ids.tolist()])

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by blanks, as the file names no decoder."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def codec(content: str) -> Codec:
    """One codec per Python worker and tokenizer."""
    return Codec(content)


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's content; it is a few MB and travels with the tasks."""
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encoded(docs: DataFrame, tokenizer: str | None = None, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the token ids and decoded text, or SHA-256 digests of both.

    One row per row of `docs`; a null text counts as empty and has no tokens, an empty
    list of ids and an empty decoded text. Equal texts get equal rows. Other columns are
    ignored. Decoding joins the token strings with blanks, as the file names no decoder.
    """
    find_package(docs.sparkSession)
    content = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))
    kinds = (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    )
    schema = f"doc_id bigint, n_tokens bigint, {kinds}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def rows(own: Codec, doc_ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        """The rows of some texts, a few at a time."""
        ids = own.encode(texts)
        for at in range(0, len(doc_ids), BATCH_ROWS):
            made = list(islice(ids, BATCH_ROWS))
            columns = [doc_ids[at : at + BATCH_ROWS], [len(i) for i in made]]
            if digests:
                columns.append([_hex(own.written(i)) for i in made])
                columns.append([_hex(own.decode(i)) for i in made])
            else:
                columns += [made, [own.decode(i) for i in made]]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(content.value)
        doc_ids, texts, size = [], [], 0
        for part in slices(batches):
            doc_ids += part.column(0).to_pylist()
            texts += part.column(1).to_pylist()
            size += part.nbytes
            if size >= TRIE_CHARS:
                yield from rows(own, doc_ids, texts)
                doc_ids, texts, size = [], [], 0
        yield from rows(own, doc_ids, texts)
        # The worker lives on for other stages, which need the memory.
        own.forget()
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op8_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and decoded text."""
    return encoded(documents(spark, sf_dir), digests=True)
