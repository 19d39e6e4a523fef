"""Byte-pair encoding and decoding by a traversal of the words' trie.

The encoding of every beginning of a word is known by its last token alone: cut the token off and the
rest is an encoded beginning again. A token may follow another when no merge across their border
would have come first, and a chain of such pairs is the one encoding that merging gives. So distinct words are put into a
trie, a depth-first walk hands the last token of each node down, and what words share is worked out once.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

#: White space as the pattern below means it, and the pattern that cuts text into words.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded words, and pairs of tokens, that a worker remembers at most.
REMEMBERED = 200_000
#: Steps of the automaton that are kept at most.
STEPS = 400_000
#: Characters encoded together, so that words meet in one trie, and rows of which texts are taken from a batch at once.
BATCH_CHARS, ROWS = 1 << 20, 512

#: A run without white space with at most one blank before it; no word reaches over its ends.
_RUN = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_NEVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as is, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> dict:
    """Merges, token bytes and added tokens of a byte-level BPE file of the tokenizers library."""
    with open(path, "rb") as f:
        return parse_vocabulary(f.read())


def parse_vocabulary(data: bytes) -> dict:
    """``read_vocabulary`` of a file's bytes."""
    file = json.loads(data)
    model = file["model"]
    before = file["pre_tokenizer"]
    if model["type"] != "BPE" or file["normalizer"] or before != {**before, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
        raise ValueError("not a plain byte-level BPE vocabulary")
    letters = byte_letters()

    def plain(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    ids = {plain(t): i for t, i in model["vocab"].items() if t not in added}
    merges = []
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[plain(left)], ids[plain(right)], ids[plain(left) + plain(right)]))
    return {"ids": ids, "merges": merges, "added": added}


class TrieEncoder:
    """Encodes words of bytes; remembers words and pairs up to a bound.

    ``prepared`` are the tables of an encoder made before, which are read only.
    """

    def __init__(self, vocabulary: dict, prepared: dict | None = None):
        if prepared is not None:
            self.__dict__.update(prepared)
            self.step, self.pairs, self.left_edge, self.right_edge = dict(self.step), {}, {}, {}
            return
        self.rank = {(a, b): i for i, (a, b, _) in enumerate(vocabulary["merges"])}
        self.parts = parts = {c: (a, b, i) for i, (a, b, c) in reversed(list(enumerate(vocabulary["merges"])))}
        byte_tokens = {t for b, t in vocabulary["ids"].items() if len(b) == 1}
        # tokens that merging can reach; others never stand in an encoding
        self.ids = {b: t for b, t in vocabulary["ids"].items() if t in byte_tokens or t in parts}
        self._link()
        self.left_edge: dict[int, tuple] = {}
        self.right_edge: dict[int, tuple] = {}
        self.pairs: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """From the single byte at an edge up to the token: the tokens there, and the ranks of the merges that end them."""
        steps, at = [], token
        while at in self.parts:
            steps.append((at, self.parts[at][2]))
            at = self.parts[at][side]
        found = [at, *[x for x, _ in reversed(steps)]], [*[r for _, r in reversed(steps)], _NEVER]
        (self.right_edge if side else self.left_edge)[token] = found
        return found

    def prepared(self) -> dict:
        """The tables that hang on the vocabulary alone."""
        return {name: value for name, value in vars(self).items() if name not in ("pairs", "left_edge", "right_edge")}

    def _link(self) -> None:
        """An automaton over the tokens: reading bytes, its state tells which tokens end here, longest first."""
        self.step: dict[int, int] = {}  # state * 256 + byte -> state
        token_at, depth = [-1], [0]
        for text, token in self.ids.items():
            at = 0
            for byte in text:
                after = self.step.get(at << 8 | byte)
                if after is None:
                    after = self.step[at << 8 | byte] = len(token_at)
                    token_at.append(-1)
                    depth.append(depth[at] + 1)
                at = after
            token_at[at] = token
        links = sorted((depth[to], key, to) for key, to in self.step.items())
        self.back = back = [0] * len(token_at)
        for d, key, to in links:
            if d > 1:
                back[to] = self._next(back[key >> 8], key & 255, False)
        self.ending: list[tuple] = [()] * len(token_at)
        for d, _, to in links:
            own = ((d, token_at[to]),) if token_at[to] >= 0 else ()
            self.ending[to] = own + self.ending[back[to]]

    def _next(self, state: int, byte: int, remember: bool = True) -> int:
        """The state after a byte: the longest beginning of a token that the text now ends with."""
        key, found, at = state << 8 | byte, None, state
        while (found := self.step.get(at << 8 | byte)) is None:
            if not at:
                found = 0
                break
            at = self.back[at]
        if remember and len(self.step) < STEPS:
            self.step[key] = found
        return found

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens leaves the border between them."""
        left, left_ranks = self.right_edge.get(a) or self._edge(a, 1)
        right, right_ranks = self.left_edge.get(b) or self._edge(b, 0)
        i = j = 0
        while True:
            across = self.rank.get((left[i], right[j]), _NEVER)
            # of equal merges the one further left comes first
            if across < left_ranks[i] and across <= right_ranks[j] and across < _NEVER:
                return False
            if left_ranks[i] == right_ranks[j] == _NEVER:
                return True
            if left_ranks[i] <= right_ranks[j]:
                i += 1
            else:
                j += 1

    def encode(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Token ids of distinct words.

        The sorted words are the trie in depth-first order: what a word shares with the one before
        is the path both have, and the last tokens along it are still there.
        """
        pairs, step, ending = self.pairs, self.step, self.ending
        out: dict[bytes, list[int]] = {}
        path = b""
        # at each byte of the path: state of the automaton, last token of the beginning that ends here, its length
        states: list[int] = []
        last: list[int] = []
        size: list[int] = []
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del states[shared:], last[shared:], size[shared:]
            state = states[-1] if shared else 0
            for end in range(shared, len(word)):
                after = step.get(state << 8 | word[end])
                state = self._next(state, word[end]) if after is None else after
                states.append(state)
                for length, token in ending[state]:
                    if length > end:
                        fits = self._whole(token)
                    else:
                        pair = last[end - length] << 24 | token
                        fits = pairs.get(pair)
                        if fits is None:
                            fits = pairs[pair] = self._may_follow(last[end - length], token)
                    if fits:
                        last.append(token)
                        size.append(length)
                        break
            path = word
            tokens, end = [], len(word)
            while end:
                tokens.append(last[end - 1])
                end -= size[end - 1]
            out[word] = tokens[::-1]
        if len(pairs) > REMEMBERED:
            pairs.clear()
        return out

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        key = -1 - token
        if key not in self.pairs:
            a, b, _ = self.parts.get(token, (None, None, 0))
            self.pairs[key] = a is None or (self._whole(a) and self._whole(b) and not self._may_follow(a, b))
        return self.pairs[key]


class Coder:
    """Texts to ids and back, as one task uses it."""

    def __init__(self, vocabulary: dict, prepared: dict | None = None):
        self.encoder = TrieEncoder(vocabulary, prepared)
        self.word = regex.compile(WORD)
        self.added = {k: np.array([v], "<u4").tobytes() for k, v in vocabulary["added"].items()}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.bytes_of = {t: b for b, t in vocabulary["ids"].items()} | {v: k.encode() for k, v in vocabulary["added"].items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _runs(self, text: str) -> list[str]:
        """The runs of a text; an added token stands as a run of its own."""
        if not self.special or not self.special.search(text):
            return _RUN.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += _RUN.findall(text[at : found.start()])
            out.append(found.group())
            at = found.end()
        return out + _RUN.findall(text[at:])

    def _learn(self, runs: set[str]) -> None:
        # letters with a blank before them or none are one word
        words_of = {
            run: [run] if (run[1:] if run[0] == " " else run).isalpha() else self.word.findall(run)
            for run in runs if run not in self.added
        }
        encoded = self.encoder.encode(list({w.encode() for words in words_of.values() for w in words}))
        packed = {w: np.array(t, "<u4").tobytes() for w, t in encoded.items()}
        for run in runs:
            self.known[run] = self.added[run] if run in self.added else b"".join(packed[w.encode()] for w in words_of[run])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED // 2:  # what is met again moves on from the older half
            self.known, self.older = {}, self.known
        runs = [self._runs(t) for t in texts]
        new = set().union(*runs)
        new.difference_update(self.known)
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new -= again
        if new:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, r)) for r in runs]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 turn into U+FFFD, unknown ids into nothing."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _batches(texts: list[str], most: int):
    first = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _per_text(docs: DataFrame, vocabulary_path: str, schema: str, row) -> DataFrame:
    """Applies ``row`` (coder, id, text, packed ids) to every document."""
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as f:
        data = f.read()

    def prepare(batches):
        for batch in batches:
            vocabulary = parse_vocabulary(data)
            tables = pickle.dumps((vocabulary, TrieEncoder(vocabulary).prepared()))
            yield pa.RecordBatch.from_pydict({"tables": pa.array([tables] * batch.num_rows, pa.binary())})

    # tables of a fixed size, made once, in a task, and sent packed; what a task learns goes with the task
    packed = spark.range(1).coalesce(1).mapInArrow(prepare, "tables binary").first()["tables"]
    shared = spark.sparkContext.broadcast(bytes(packed))
    names = [part.split()[0] for part in schema.split(",")]

    def work(batches):
        coder = None
        for batch in batches:
            coder = coder or Coder(*pickle.loads(shared.value))
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = some.column("doc_id").to_pylist()
                texts = [t or "" for t in some.column("text").to_pylist()]
                for first, last in _batches(texts, BATCH_CHARS):
                    rows = [row(coder, *x) for x in zip(ids[first:last], texts[first:last], coder.encode(texts[first:last]))]
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=out)

    out = to_arrow_schema(_parse_datatype_string(schema))
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def encode_documents(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, ids): token ids of every whole text.

    A NULL or empty text has no ids. Strings of the vocabulary's added tokens are those tokens. Every row of
    ``docs`` gives one row, repeated ones too; a NULL doc_id stays NULL; an empty table gives no rows; other
    columns are not looked at. A task remembers a bounded number of words and pairs, the vocabulary is of fixed size.
    """
    return _per_text(
        docs, vocabulary_path, "doc_id bigint, ids array<int>",
        lambda coder, doc, text, ids: (doc, np.frombuffer(ids, "<u4").astype(np.int32)),
    )


def digest_documents(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again.

    Cases as in ``encode_documents``; a text without ids has the digests of nothing.
    """

    def row(coder, doc, text, ids):
        return (
            doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids).encode()).hexdigest(),
        )

    return _per_text(docs, vocabulary_path, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row)
