"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is just one token that can be last in its encoding. An automaton over the vocabulary gives
all tokens that end at a position (the suffix matches); the one that is compatible with the last token of the prefix before
it is stored, and back-pointers from the end give the ids. Two tokens are compatible when no merge across their border
would fire before the merges that make them.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import small_batches

#: The pieces that byte-level BPE splits a text into.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts of Latin letters alone, with the classes spelt out: the plain engine is the faster one.
_SPACE, _LETTER, _NUMBER = r"\t-\r \x85\xa0", r"A-Za-zªµºÀ-ÖØ-öø-ɏ", r"0-9²³¹¼½¾"
NOT_LATIN = re.compile("[^\\x00-\u024f]")
LATIN_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Pieces remembered by each worker in each of two generations; when one is full, the older is forgotten.
REMEMBERED = 50_000
#: Code points of text that are encoded together.
BATCH_CHARS = 1 << 20
#: Rows decoded at once.
DECODE_ROWS = 256


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model, to_byte = spec["model"], {c: b for b, c in enumerate(byte_chars())}
        vocab: dict[str, int] = self.model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for word, i in vocab.items():
            self.bytes[i] = bytes(to_byte[c] for c in word)
        for word, i in self.special.items():
            self.bytes[i] = word.encode()
        self.sizes = np.array([len(w) for w in self.bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of several lists of ids, one after another, by where each begins and the last ends."""
        sizes = self.sizes[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        data = self.blob[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        at = ends[offsets - offsets[0]]
        inner = at[:-1][at[:-1] < len(data)]
        try:
            data.tobytes().decode()
            whole = not ((data[inner] & 0xC0) == 0x80).any()  # no text begins within a character
        except UnicodeDecodeError:
            whole = False
        if not whole:
            return pa.array([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])], pa.string())
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))


class Codec(Vocabulary):
    """Encoder for one vocabulary file, with its merges and the automaton over its tokens."""

    def __init__(self, path: str):
        super().__init__(path)
        vocab = self.model["vocab"]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        #: The merge that makes each token, and what comes after all merges.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(self.model.pop("merges")):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = rank
            self.made.setdefault(vocab[left + right], (a, b, rank))
        self.never = len(self.rank) + 1
        self.size = self.sizes.tolist()
        self._build({i for i in (vocab.get(c, -1) for c in byte_chars()) if i >= 0} | {*self.made})
        del self.model
        #: Ids of pieces, as the bytes of 32-bit numbers.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.tested: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens along a token's left (0) or right (1) edge, each with the rank of the merge that ends it."""
        out, until = [(token, self.never)], self.never
        while token in self.made:
            until = self.made[token][2]
            token = self.made[token][side]
            out.append((token, until))
        return out

    def _build(self, tokens: set[int]) -> None:
        """The automaton over the tokens' bytes: a state for each prefix of a token, and for each state the longest token that
        is a suffix of it, the next shorter one by way of `shorter`."""
        self.next: dict[int, int] = {}
        ends: dict[int, int] = {}
        states, parent = 1, [(0, 0)]
        for t in sorted(tokens):
            at = 0
            for byte in self.bytes[t]:
                key = at << 8 | byte
                if key not in self.next:
                    self.next[key] = states
                    parent.append((at, byte))
                    states += 1
                at = self.next[key]
            ends[at] = t
        depth = [0] * states
        for state in range(1, states):
            depth[state] = depth[parent[state][0]] + 1
        self.fail, self.token, self.shorter = [0] * states, [ends.get(state, -1) for state in range(states)], [0] * states
        for state in sorted(range(1, states), key=depth.__getitem__):
            up, byte = parent[state]
            to = self.fail[up]
            while up and to and to << 8 | byte not in self.next:
                to = self.fail[to]
            self.fail[state] = to = self.next.get(to << 8 | byte, 0) if up else 0
            self.shorter[state] = to if self.token[to] >= 0 else self.shorter[to]
        self.trie_size = len(self.next)

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte; steps that fall back to shorter suffixes are remembered."""
        at, key = state, state << 8 | byte
        while at and at << 8 | byte not in self.next:
            at = self.fail[at]
        to = self.next.get(at << 8 | byte, 0)
        if len(self.next) < self.trie_size + REMEMBERED:
            self.next[key] = to
        return to

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of a and b is a, b: no pair (x, y) on their edges merges while both stand.

        The merge must come before the one that takes x into a. It may tie with the one that takes y into b: of equal
        pairs the leftmost merges first.
        """
        rank, left, fits = self.rank.get, self._edge(b, 0), True
        for x, x_ends in self._edge(a, 1):
            for y, y_ends in left:
                r = rank((x, y))
                if r is not None and r < x_ends and r <= y_ends:
                    fits = False
        if len(self.tested) >= 2 * REMEMBERED:
            self.tested.clear()
        self.tested[a << 32 | b] = fits
        return fits

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces and remember them. They go in the order of their bytes, so that the states and last tokens of the
        prefixes that a piece shares with the one before it are there already."""
        step, token, shorter, size, tested = self.next, self.token, self.shorter, self.size, self.tested
        states, last, before = [0], [-1], b""
        for raw, piece in sorted((p.encode(), p) for p in pieces):
            same, n = 0, min(len(before), len(raw))
            while same < n and before[same] == raw[same]:
                same += 1
            del states[same + 1 :], last[same + 1 :]
            state = states[same]
            for end in range(same, len(raw)):
                to = step.get(state << 8 | raw[end])
                state = self.step(state, raw[end]) if to is None else to
                states.append(state)
                at, found = state if token[state] >= 0 else shorter[state], -1
                while at:  # the tokens that end here, the longest first
                    t = token[at]
                    left = last[end + 1 - size[t]]
                    if left < 0:
                        fits = size[t] == end + 1
                    else:
                        fits = tested.get(left << 32 | t)
                        if fits is None:
                            fits = self.compatible(left, t)
                    if fits:
                        found = t
                        break
                    at = shorter[at]
                last.append(found)
            ids, at = [], len(raw)
            while at:
                ids.append(last[at])
                at -= size[last[at]]
            self.known[piece] = array("i", ids[::-1]).tobytes()
            before = raw

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Pieces that are not known yet are gathered over all texts and encoded together."""
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {}
        split, new = [], set()
        for text in texts:
            pieces: list[str] = []
            cut = PIECE if NOT_LATIN.search(text) else LATIN_PIECE
            for part in self.split_special.split(text) if any(s in text for s in self.special) else [text]:
                pieces += [part] if part in self.special else cut.findall(part)
            split.append(pieces)
            new.update(set(pieces).difference(self.known))
        for p in [p for p in new if p in self.before or p in self.special]:
            self.known[p] = self.before.get(p) or array("i", [self.special[p]]).tobytes()
            new.discard(p)
        self.learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.int32) for pieces in split]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The decoder alone: a task that decodes has no need of the automaton's memory."""
    v = Vocabulary(path)
    del v.model, v.bytes
    return v


def encoded(batches: Iterator[pa.RecordBatch], vocab_path: str, id_col: str) -> Iterator[pa.RecordBatch]:
    c = codec(vocab_path)
    for b in batches:
        first, texts, seen = 0, [], 0
        for row, text in enumerate(b.column(1), 1):
            texts.append(text.as_py() or "")
            seen += len(texts[-1])
            if seen >= BATCH_CHARS or row == b.num_rows:
                ids = c.encode(texts)
                offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, row - first), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))], names=[id_col, "ids"])
                first, texts, seen = row, [], 0


def decoded(batches: Iterator[pa.RecordBatch], c: Vocabulary, id_col: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1).fill_null([]) if b.column(1).null_count else b.column(1)
        offsets = lists.offsets.to_numpy()
        for at in range(0, b.num_rows, DECODE_ROWS):
            some = offsets[at : at + DECODE_ROWS + 1]
            texts = c.decode(lists.values[some[0] : some[-1]].to_numpy(), some)
            n = len(some) - 1
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, n), lists.slice(at, n), texts], names=[id_col, "ids", "decoded"])


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for each row; null texts count as empty and give an empty array. Repeated rows are encoded each,
    texts are read whole, other columns are ignored.

    vocab_path must be readable where the executors run, as part of their installation.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(lambda it: encoded(it, vocab_path, id_col), f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, vocab_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) for each row of tokens(id, ids); null ids give an empty text. Bytes that are not UTF-8 are replaced."""
    kind = tokens.schema[id_col].dataType.simpleString()
    return small_batches(tokens.select(id_col, "ids")).mapInArrow(lambda it: decoded(it, vocabulary(vocab_path), id_col), f"`{id_col}` {kind}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode(encode(docs)) by one worker a task, which needs the vocabulary but once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decoded(encoded(batches, vocab_path, id_col), codec(vocab_path), id_col)

    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(decoded: DataFrame, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts and digests of decode()'s rows, with those of its columns that are to be kept."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(id_col, *keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
