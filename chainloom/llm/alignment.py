"""Cross-tokenizer alignment by inverted pair bitmaps.

A text's bytes are cut into tokens by two tokenizers, A (byte-level BPE) and B (SentencePiece with byte fallback). Offsets where
tokens of both end cut the tokens into groups, and the A and B tokens of one group are linked. How many documents of the corpus
hold a pair of ids linked is the pair's count, which scores the links of each document.

Tasks gather their documents into chunks. Of each chunk and pair there is a bitmap of the documents that hold the pair, and
planes for its multiplicity: plane 0 has the documents, plane k those whose further links have bit k - 1 set. A bitmap is a
sorted list of 16-bit places while that is the smaller form, else plain bits. Chunks share no document, so a pair's bitmaps are
merged by OR as containers side by side and their popcounts add up to its count. Scored pairs go back to their bitmaps, the
postings, which hand the scores to the documents of their chunk. A pair has one posting a chunk and plane however many
documents hold it, so the commonest pair is no hot key.

No token of either tokenizer runs over a space that follows a character which is not white space (of B this is read off its
pieces; where it fails, texts are encoded whole). Texts are therefore encoded word by word, and the words that a worker has
met are remembered with their tokens, groups and links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.llm.bpe import PIECE, byte_chars
from chainloom.llm.shared import materialize, small_batches

#: Documents of a chunk at most (places have 16 bits), and words after which a chunk is closed.
CHUNK_DOCS, CHUNK_WORDS = 1 << 13, 1 << 20
#: Bytes of a bitmap of plain bits; a list of places is always shorter.
PLAIN = CHUNK_DOCS // 8
#: Words that a worker remembers, the longest of them in characters, and characters of a text that are split into words at once.
REMEMBERED, LONGEST, BLOCK = 300_000, 64, 1 << 20
#: Bits of a B id within a pair, and of a count that is sorted along with pair and place.
B_BITS, N_BITS = 16, 18
#: Where both tokenizers cut, and what a text has if some of its spaces are no such places.
CUT, ODD = re.compile(r"(?<=\S) (?=[\s\S])"), re.compile(r"(?:\A|\s) |\s\Z")


class Ranked:
    """A's encoder: byte-level BPE by the ranks of its merges, which are its ids in order."""

    def __init__(self, path: str, vocab: dict[str, int], merges: list, to_bytes: dict[int, bytes]):
        import tiktoken
        from tokenizers import Tokenizer

        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        self.ranks = made == sorted(set(made)) and all(i < made[0] for i, w in to_bytes.items() if len(w) == 1)
        if self.ranks:
            single = {i for i, w in to_bytes.items() if len(w) == 1} | set(made)
            self.by_rank = tiktoken.Encoding("a", pat_str=PIECE.pattern, mergeable_ranks={to_bytes[i]: i for i in single}, special_tokens={})
        else:
            self.whole = Tokenizer.from_file(path)
            self.whole.encode_special_tokens = True
            self.whole.no_truncation()
            self.whole.no_padding()

    def encode(self, text: str) -> list[int]:
        return self.by_rank.encode_ordinary(text) if self.ranks else self.whole.encode(text, add_special_tokens=False).ids


def spelling(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some tokens the bytes of all, one after another, where each starts there, and how many it has."""
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def spelt(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a list of tokens, and where each of them ends."""
    blob, start, size = table
    sizes = size[ids]
    ends = np.cumsum(sizes)
    return blob[np.repeat(start[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


class Aligner:
    """Groups and links of words by two vocabulary files, remembered."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        a_bytes = {i: bytes(to_byte[c] for c in word) for word, i in model["vocab"].items() if all(c in to_byte for c in word)}
        self.a = Ranked(a_path, model["vocab"], model["merges"], a_bytes)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        n_a = 1 + max(a_bytes)
        if len(pieces) > 1 << B_BITS or n_a > 1 << 32 - B_BITS:
            raise ValueError("the ids of a pair must fit 32 bits")
        self.spell_a, self.spell_b = spelling([a_bytes.get(i, b"") for i in range(n_a)]), spelling(b_bytes)
        self.decimal = spelling([str(i).encode() for i in range(max(n_a, len(pieces)))])
        self.splits = not any(re.search("[^\u2581]\u2581", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        #: Of each word its groups as text, None where the tokens do not spell it; A tokens, B tokens, groups and links; and its
        #: linked pairs, from start to start + length.
        self.listed: list[bytes | None] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.uint32)
        self.late: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def gather(self) -> None:
        """Put what the last words have brought behind the rest."""
        if self.late:
            sizes, lengths, pairs = (np.concatenate(x) for x in zip(*self.late))
            self.sizes, self.length, self.pairs = np.concatenate((self.sizes, sizes)), np.concatenate((self.length, lengths)), np.concatenate((self.pairs, pairs))
            self.start = np.cumsum(self.length) - self.length
            self.late = []

    def learn(self, words: list[str], remember: bool = True) -> list[int]:
        """Places of the words' entries. Words are joined by spaces and encoded together, since no token runs over those."""
        first, at, size = len(self.listed), 0, 0
        for k, w in enumerate(words):
            size += len(w)
            if size >= BLOCK >> 4 or not self.splits or k == len(words) - 1:
                self._learn(words[at : k + 1])
                at, size = k + 1, 0
        places = list(range(first, len(self.listed)))
        if remember:
            self.known.update(zip(words, places))
        return places

    def _learn(self, words: list[str]) -> None:
        joined = " ".join(words)
        raw = np.frombuffer((" " + joined).encode(), np.uint8)
        a, b = np.array(self.a.encode(" " + joined), np.int64), np.array(self.b.encode(joined), np.int64)
        (a_raw, a_end), (b_raw, b_end) = spelt(a, self.spell_a), spelt(b, self.spell_b)
        if not (np.array_equal(a_raw, raw) and np.array_equal(b_raw, raw)):
            if len(words) > 1:
                for w in words:
                    self._learn([w])
            else:
                self.listed.append(None)
                self.late.append((np.zeros((1, 4), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)))
            return
        common = a_end[np.searchsorted(b_end, a_end) < np.searchsorted(b_end, a_end, "right")]
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        n_a, n_b = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
        last_group = np.searchsorted(common, np.cumsum([len(w.encode()) + 1 for w in words]))  # of each word
        groups = np.diff(last_group, prepend=-1)
        by_word = lambda x: np.add.reduceat(x, last_group + 1 - groups)
        self.listed += self._text(a, a_group, b, b_group, by_word(n_a + n_b))
        links = n_a * n_b
        # Each A token with all B tokens of its group.
        times = n_b[a_group]
        first_b = np.cumsum(n_b) - n_b
        of_b = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[a_group], times)
        pairs = np.repeat(a, times).astype(np.uint32) << np.uint32(B_BITS) | b[of_b].astype(np.uint32)
        self.late.append((np.stack((by_word(n_a), by_word(n_b), groups, by_word(links)), axis=1), by_word(links), pairs))

    def _text(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, per_word: np.ndarray) -> list[bytes]:
        """The groups of each word, as decimal ids with their separators; per_word: how many ids it has."""
        side = 2 * np.concatenate((a_group, b_group)) + np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(side, kind="stable")
        ids, side = np.concatenate((a, b))[order], side[order]
        digits, ends = spelt(ids, self.decimal)
        after = np.where(np.diff(side, append=-1) == 0, ord(","), np.where(side % 2 == 0, ord("|"), ord(";"))).astype(np.uint8)
        text = np.insert(digits, ends, after).tobytes()
        ends = (ends + np.arange(1, len(ends) + 1))[np.cumsum(per_word) - 1].tolist()
        return [text[x : y - 1] for x, y in zip([0, *ends], ends)]

    def words(self, part: str) -> list[str]:
        return [part] if not self.splits else CUT.split(part) if ODD.search(part) else part.split(" ")

    def meet(self, texts: list[str | None]) -> None:
        """Learn what is new in some texts at once; texts of several blocks are left to places()."""
        new: set[str] = set()
        for text in texts:
            if text and len(text) <= BLOCK:
                new.update(self.words(text))
        new.difference_update(self.known)
        self.learn([w for w in new if len(w) <= LONGEST and not w[-1:].isspace()])

    def places(self, text: str) -> Iterator[list[int]]:
        """Entries of a text's words, some at a time."""
        for part in self._parts(text):
            words = self.words(part)
            try:
                yield list(map(self.known.__getitem__, words))
                continue
            except KeyError:
                new = set(words).difference(self.known)
            once = {w for w in new if len(w) > LONGEST or w[-1:].isspace()}
            self.learn(list(new - once))
            own = {w: self.learn([w], remember=False)[0] for w in once}  # nothing may follow white space at the end of a word
            yield [own[w] if w in own else self.known[w] for w in words]

    def _parts(self, text: str) -> Iterator[str]:
        """The text in blocks that end before a space at which both tokenizers cut; the space itself is left out."""
        at = 0
        while self.splits and len(text) - at > BLOCK:
            cut = CUT.search(text, at + BLOCK)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:] if at else text


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def sorted_counts(codes: np.ndarray, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (code, pos), as code << 13 | pos in order, and the sums of their n."""
    keys = codes.astype(np.uint64) << np.uint64(13) | pos.astype(np.uint64)
    if n.max(initial=0) < 1 << N_BITS:
        packed = np.sort(keys << np.uint64(N_BITS) | n.astype(np.uint64))
        keys, n = packed >> np.uint64(N_BITS), (packed & np.uint64((1 << N_BITS) - 1)).astype(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first) if len(first) else n[:0]


def bitmaps(code: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(codes, popcounts, bitmaps) of documents by sorted code and place: those that are lists of places, then the plain ones."""
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(code)), bool), code[1:] != code[:-1])))
    size = np.diff(np.append(first, len(code)))
    plain = size * 2 >= PLAIN
    if not plain.all():
        data = pos[~np.repeat(plain, size)].astype("<u2") if plain.any() else pos.astype("<u2")
        offsets = np.concatenate(([0], np.cumsum(size[~plain] * 2))).astype(np.int32)
        yield code[first[~plain]], size[~plain], pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    rows = np.flatnonzero(plain)
    for at in range(0, len(rows), 1024):
        some = rows[at : at + 1024]
        bits = np.zeros((len(some), CHUNK_DOCS), bool)
        for k, row in enumerate(some):
            bits[k, pos[first[row] : first[row] + size[row]]] = True
        data = np.packbits(bits, axis=1, bitorder="little")
        offsets = np.arange(0, (len(some) + 1) * PLAIN, PLAIN, dtype=np.int32)
        yield code[first[some]], size[some], pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


NAMES = ["id", "chunk", "pos", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "plane", "n_docs", "bits"]
LONG, INT, TEXT, BYTES = pa.int64(), pa.int32(), pa.string(), pa.binary()
KINDS = [LONG, INT, LONG, LONG, LONG, LONG, TEXT, INT, INT, INT, INT, BYTES]


class Chunk:
    """Documents of one chunk, and their words' entries."""

    def __init__(self, number: int, of: Aligner):
        self.number, self.of = number, of
        self.ids: list[pa.Scalar] = []
        self.digests: list[str] = []
        self.entries: list[np.ndarray] = []
        self.words = 0

    def add(self, row_id: pa.Scalar, text: str | None) -> None:
        digest, entries, listed = hashlib.sha256(), [], self.of.listed
        for places in self.of.places(text) if text else ():
            own = [listed[p] for p in places]
            if None in own:
                entries = []
                break
            if entries:
                digest.update(b";")
            digest.update(b";".join(own))
            entries.append(np.array(places, np.int64))
        self.ids.append(row_id)
        self.digests.append(digest.hexdigest() if entries else "")
        self.entries.append(np.concatenate(entries) if entries else np.zeros(0, np.int64))
        self.words += len(self.entries[-1])

    def rows(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then the postings."""
        n, of = len(self.ids), self.of
        of.gather()
        pos = np.repeat(np.arange(n, dtype=np.int64), [len(e) for e in self.entries])
        # Distinct (document, word) and how often.
        keys = np.sort(pos << 32 | np.concatenate(self.entries))
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        times = np.diff(np.append(first, len(keys)))
        pos, word = keys[first] >> 32, keys[first] & 0xFFFFFFFF
        sums = np.zeros((n, 4), np.int64)
        if len(pos):
            starts = np.flatnonzero(np.concatenate(([True], pos[1:] != pos[:-1])))
            sums[pos[starts]] = np.add.reduceat(of.sizes[word] * times[:, None], starts)
        docs = [pa.array([i.as_py() for i in self.ids], id_type), pa.array(np.full(n, self.number)), pa.array(np.arange(n, dtype=np.int32)), *(pa.array(sums[:, k]) for k in range(4)), pa.array(self.digests)]
        yield self._batch(docs, n, id_type)

        reps = of.length[word]
        at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps - of.start[word], reps)
        keys, links = sorted_counts(of.pairs[at], np.repeat(pos, reps), np.repeat(times, reps))
        code, pos = (keys >> np.uint64(13)).astype(np.int64), (keys & np.uint64(CHUNK_DOCS - 1)).astype(np.int64)
        more = links - 1
        for plane in range(1 + int(more.max(initial=0)).bit_length()):
            here = slice(None) if plane == 0 else (more >> (plane - 1) & 1).astype(bool)
            for c, n_docs, bits in bitmaps(code[here], pos[here]):
                whole = [np.full(len(c), self.number), None, None, None, None, None, None]
                own = [(c >> B_BITS).astype(np.int32), (c & ((1 << B_BITS) - 1)).astype(np.int32), np.full(len(c), plane, np.int32), n_docs.astype(np.int32)]
                yield self._batch([None, *(None if x is None else pa.array(x) for x in whole), *map(pa.array, own), bits], len(c), id_type)

    @staticmethod
    def _batch(columns: list[pa.Array | None], n: int, id_type: pa.DataType) -> pa.RecordBatch:
        kinds = [id_type, *KINDS]
        columns = columns + [None] * (len(kinds) - len(columns))
        return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else c for c, k in zip(columns, kinds)], names=NAMES)


def chunked(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, chunk_docs: int, chunk_words: int) -> Iterator[pa.RecordBatch]:
    of, task = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
    chunk, id_type = Chunk(task, of), None
    for b in batches:
        id_type, texts = b.column(0).type, b.column(1).to_pylist()
        of.meet(texts)
        for row_id, text in zip(b.column(0), texts):
            chunk.add(row_id, text)
            if len(chunk.ids) >= chunk_docs or chunk.words >= chunk_words:
                yield from chunk.rows(id_type)
                if len(of.listed) > REMEMBERED:
                    of.forget()
                chunk = Chunk(chunk.number + 1, of)
    if chunk.ids:
        yield from chunk.rows(id_type)


def handed_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, pos, n_best, count_sum) from scored postings (chunk, plane, n, best, bits), which come sorted by chunk."""
    chunk, sums = None, np.zeros((2, CHUNK_DOCS), np.int64)

    def close() -> pa.RecordBatch:
        some = np.flatnonzero(sums[1])
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(some), chunk)), pa.array(some.astype(np.int32)), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["chunk", "pos", "n_best", "count_sum"])
        sums[:] = 0
        return out

    for b in batches:
        chunks, plane, n, best = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        bits = b.column(4)
        size = pc.binary_length(bits).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        start = bits.buffers()[1]
        low = np.frombuffer(start, np.int32)[bits.offset]
        data = np.frombuffer(bits.buffers()[2] or b"", np.uint8)[low : low + offsets[-1]]
        weight = np.left_shift(np.int64(1), np.maximum(plane.astype(np.int64) - 1, 0))
        edges = np.flatnonzero(np.concatenate(([True], chunks[1:] != chunks[:-1], [True])))
        for lo, hi in zip(edges[:-1], edges[1:]):
            if chunks[lo] != chunk:
                if chunk is not None:
                    yield close()
                chunk = chunks[lo]
            plain = size[lo:hi] == PLAIN
            rows = np.arange(lo, hi)[~plain]
            at = data[offsets[lo] : offsets[hi]][~np.repeat(plain, size[lo:hi])].view("<u2").astype(np.int64)
            of = np.repeat(rows, size[rows] // 2)
            np.add.at(sums[1], at, weight[of] * n[of])
            np.add.at(sums[0], at[best[of]], weight[of][best[of]])
            for row in np.arange(lo, hi)[plain]:
                here = np.flatnonzero(np.unpackbits(data[offsets[row] : offsets[row + 1]], bitorder="little"))
                sums[1, here] += weight[row] * n[row]
                if best[row]:
                    sums[0, here] += weight[row]
    if chunk is not None:
        yield close()


def postings(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_docs: int = CHUNK_DOCS, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, postings): a row for each row of docs, and one for each chunk, pair and plane."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, chunk bigint, pos int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, a int, b int, plane int, n_docs int, bits binary"
    made = small_batches(docs.select(id_col, text_col)).mapInArrow(lambda it: chunked(it, a_path, b_path, min(chunk_docs, CHUNK_DOCS), chunk_words), schema)
    made = materialize(made, "align-postings")
    return made.where(F.col("a").isNull()).select(*NAMES[:8]), made.where(F.col("a").isNotNull()).select("chunk", "a", "b", "plane", "n_docs", "bits")


def pair_counts(bitmaps: DataFrame) -> DataFrame:
    """(a, b, n, best): the documents that hold each pair, and whether no other pair of its A id has more."""
    counts = bitmaps.where("plane = 0").groupBy("a", "b").agg(F.sum("n_docs").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_docs: int = CHUNK_DOCS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row for each row of docs: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A encodes a space and the text, B the text, to which it adds the space; strings of special tokens are plain text. Null and
    empty texts, and texts that the tokens of A or B do not spell (B takes U+2581 for a space), have zeros and an empty digest. Rows count one by one,
    also those that repeat an id or a text; null ids are kept as they are. Links of a group are all its pairs of occurrences, so
    count_sum counts a pair as often as it is linked. Texts are read whole, other columns are ignored, and an empty table gives an
    empty result. Both files must be readable where the executors run.
    """
    rows, bitmaps = postings(docs, a_path, b_path, id_col, text_col, chunk_docs, chunk_words)
    scored = bitmaps.join(pair_counts(bitmaps), ["a", "b"]).select("chunk", "plane", "n", "best", "bits")
    sums = small_batches(scored.repartition("chunk").sortWithinPartitions("chunk")).mapInArrow(handed_out, "chunk bigint, pos int, n_best bigint, count_sum bigint")
    zero = F.lit(0).cast("bigint")
    out = rows.join(sums, ["chunk", "pos"], "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
