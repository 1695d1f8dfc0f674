"""Packing by lexical retrieval: BM25 neighbours fill the window of a seed document.

Texts are tokenised in the tasks that read them. Pieces of a full window are
sequences by themselves; of each document only the rest (shorter than a
window) takes part in the packing, as its token ids.

Related rests are brought together by content. A bounded sample (``SAMPLE``
documents) gives k-means centres of their word vectors; every rest goes to the
leaf of its nearest centre. The number of leaves follows the number of
documents up to ``LEAVES``; a leaf that is larger is split by sign bits of the
vector's difference from the centre, and what is still too large (a group of
copies) is dealt by a hash, so a shard is bounded in documents and tokens, and
a hot source or a third of all rows as copies spread over many.

In a shard an inverted index with BM25 weights is built over the words of the
rests (ids from one word start to the next). Document frequencies and the mean
length are those of all documents: every shard counts its terms, the counts
are added by term, and a shard gets those that two of its documents have.
Seeds are taken in order and searched with all their terms in their shard; the
unused neighbours of a seed, best score first and all that have a score, fill
its window as far as they fit whole, until ``BLOCK`` that do not fit have been
met; what then gapes is filled by cutting the best of those, whose remainder
stays in the pool and is the next seed. Where a seed has no neighbour left, the
documents just added are searched for; without any, the next unused rest
follows. So every window is full. What is left at the end of a shard is cut
into sequences whose lengths are powers of two: no padding at all.

A shard's words are hashed and weighed ``RUN`` ids at a time, and its tasks
need no tokenizer: a worker holds the postings of one shard, not the
temporary arrays of all its ids.

The rests are written once, as token ids; the driver gets the sample's ids
(at most ``SAMPLE`` windows), one row per leaf, and no text. Token ids are
those of the ``tokenizers`` file. Where both give the same ids (plain Latin
text without an added token), the same vocabulary is applied through
``tiktoken``, which is several times faster; anything else goes to
``tokenizers``. Plain texts are cut into pieces up to ``ROWS`` texts at a time,
and each distinct piece of them is merged once, unless it was met before (a task
remembers at most ``KNOWN`` pieces).

Defined results: a null or empty text is the single id 1; repeated rows and
null ids are documents of their own; ties go to the earlier row by id and
hash; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import U, mix
from ._common import give_back, order_id, parts_for, staged, text_or_empty, tidied

WINDOW = 2048
END_ID = 1
SHARD_DOCS = 4096
SHARD_MEAN = 1024
K1, B = 1.2, 0.75
BLOCK = 32
DROP = 0.65
DENSE = 12
SAMPLE = 4096
LEAVES = 128
DIMS = 512
BUCKETS = 1 << 16
ROUNDS = 12
CODE_BITS = 12
DEAL_BITS = 22
SEQUENCE_BITS = 22
DOC_BITS = 20
ROWS = 1024
CHARS = 1 << 22
KNOWN = 1 << 18
RUN = 1 << 18
_SPREAD = U(0x9E3779B97F4A7C15)

# Other characters than these may be classed differently by the two libraries' tables.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏ]")

# Kinds of characters of plain text; all from 0x100 on are letters, as 0xff is.
_END, _LETTER, _DIGIT, _SPACE, _SIGN = range(5)
_KIND = bytes(
    _END if k == 0 else _SPACE if chr(k).isspace() else {"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(k))[0], _SIGN) for k in range(256)
)


def tokenizer_files() -> tuple[str, str]:
    """The default vocabulary: for ``tokenizers``, and the same as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    def __init__(self, json_path: str, ranks_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        self.added = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.ranks_path = ranks_path
        size = max(self.slow.get_vocab().values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # pieces met before, at most KNOWN, and the ids of each; the zero is the end of a text
        self.known = pa.array([b"\0"])
        self.known_ids = pa.array([np.array([END_ID], dtype=self.dtype).tobytes()])
        # ids that begin a word: a byte-level space or line break first
        self.opens = np.zeros(size, dtype=bool)
        self.opens[[i for t, i in self.slow.get_vocab().items() if t[:1] in "ĠĊĉč"]] = True

    # the driver loads none of these

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        with open(self.ranks_path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}

    def _tiktoken(self, name: str, pattern: str):
        import tiktoken

        return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def fast(self):
        """For a whole plain text."""
        import public_tokenizers

        return self._tiktoken("ranks", public_tokenizers.PATTERN)

    @cached_property
    def merge(self):
        """For pieces that are cut already, a zero between them."""
        return self._tiktoken("pieces", r"\x00|[^\x00]+")

    def plain(self, text: str) -> bool:
        return bool(self.ranks_path) and not _OTHER.search(text) and not any(t in text for t in self.added)

    def every(self, texts: list[str]) -> list[np.ndarray]:
        """``ids`` of every text; plain ones are taken together, ``CHARS`` characters at a time."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if len(text) > CHARS or not self.plain(text):
                out[k] = self.ids(text)
                continue
            if size + len(text) > CHARS:
                self._fill(out, group, texts)
                group, size = [], 0
            group.append(k)
            size += len(text)
        self._fill(out, group, texts)
        return out

    def _fill(self, out: list, group: list[int], texts: list[str]) -> None:
        if not group:
            return
        pieces, ends = pieces_of([texts[k] for k in group])
        coded = pieces.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.known)
        new = coded.dictionary.filter(place.is_null())
        place = place.fill_null(-1).to_numpy().copy()
        place[place < 0] = np.arange(len(self.known), len(self.known) + len(new))
        merged = pa.concat_arrays([self.known_ids, self._merged(new)])
        _, offsets, ids = merged.take(pa.array(place[coded.indices.to_numpy()])).buffers()
        if len(merged) <= KNOWN:
            self.known, self.known_ids = pa.concat_arrays([self.known, new]), merged
        elif len(coded.dictionary) <= KNOWN:
            self.known, self.known_ids = coded.dictionary, merged.take(pa.array(place))
        at = (np.frombuffer(offsets, dtype=np.int32)[ends + 1] // self.dtype.itemsize).tolist()
        ids = np.frombuffer(ids, dtype=self.dtype, count=at[-1])
        for k, a, b in zip(group, at, at[1:]):
            out[k] = ids[a:b]

    def _merged(self, pieces: pa.BinaryArray) -> pa.BinaryArray:
        """The ids of every piece."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), b"\0")[0].as_py()
        ids = self.merge.encode_to_numpy(joined.decode(), disallowed_special=()).astype(self.dtype)
        cut = np.flatnonzero(ids == self.ranks[b"\0"])
        ids = np.delete(ids, cut)
        # what stands before the zeros, without them
        offsets = np.concatenate([[0], cut - np.arange(len(cut)), [len(ids)]])[: len(pieces) + 1] * self.dtype.itemsize
        return pa.BinaryArray.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])

    def ids(self, text: str) -> np.ndarray:
        if self.plain(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.slow.encode(text, add_special_tokens=False).ids
        return np.append(np.asarray(ids, dtype=self.dtype), self.dtype.type(END_ID))


def pieces_of(texts: list[str]) -> tuple[pa.BinaryArray, np.ndarray]:
    """Plain texts as ``public_tokenizers.PATTERN`` cuts them, one after the other, a zero before each and after the last; the numbers of the zeros."""
    joined = "\0" + "\0".join(texts) + "\0"
    char = np.minimum(np.frombuffer(joined.encode("utf-16-le"), dtype="<u2"), 0xFF).astype(np.uint8)
    kind = np.frombuffer(char.tobytes().translate(_KIND), dtype=np.uint8)
    opens = np.append(True, np.append(kind[1:] != kind[:-1], True))
    ends = np.flatnonzero(kind == _END)
    opens[ends] = True
    # the last white space before something else stands alone, or a blank before that
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _END))
    opens[last] = True
    opens[last[char[last] == ord(" ")] + 1] = False
    # 's 't 'm 'd 're 've 'll where a piece begins
    quote = np.flatnonzero(char == ord("'"))
    quote = quote[opens[quote]]
    one, two = char[quote + 1], char[np.minimum(quote + 2, len(char) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
    long = (np.isin(one, np.frombuffer(b"rv", dtype=np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    opens[quote[short | long] + 1] = False
    opens[quote[short] + 2] = True
    opens[quote[long] + 3] = True
    at = np.flatnonzero(opens)
    data = joined.encode()
    begin = at.astype(np.int32)
    if len(data) != len(char):  # some characters are two bytes
        begin[1:] += np.cumsum(np.add.reduceat(char >= 0x80, at[:-1], dtype=np.int32), dtype=np.int32)
    pieces = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(begin), pa.py_buffer(data)])
    return pieces, np.searchsorted(at, ends)


@lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str | None) -> Encoder:
    return Encoder(json_path, ranks_path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@lru_cache(maxsize=2)
def _spread(size: int) -> np.ndarray:
    return mix((np.arange(size, dtype=U) + U(1)) * _SPREAD)


def runs_of(rests: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Consecutive rests of at most ``RUN`` ids (or a single one) and the number of the first: what is gone through at a time."""
    at = size = 0
    for k, r in enumerate(rests):
        if k > at and size + len(r) > RUN:
            yield at, rests[at:k]
            at, size = k, 0
        size += len(r)
    if rests:
        yield at, rests[at:]


def words_of(rests: list[np.ndarray], opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word: the ids from one word start to the next."""
    size = np.array([len(r) for r in rests])
    ids = np.concatenate(rests)
    start = opens[ids]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    start[first] = True
    at = np.flatnonzero(start)
    odd = np.arange(1, 2 * len(ids), 2) - np.repeat(2 * at, np.diff(np.append(at, len(ids))))  # 1, 3, 5, ... in a word
    term = mix(np.add.reduceat(_spread(len(opens))[ids] * odd.view(U), at))
    return term, np.repeat(np.arange(len(rests)), np.diff(np.append(np.searchsorted(at, first), len(at))))


class Postings:
    """Documents and counts of every term of some documents; a term keeps the upper 44 bits of its hash."""

    def __init__(self, rests: list[np.ndarray], opens: np.ndarray):
        self.n = len(rests)
        bits = U(DOC_BITS)
        keys, counts, words = [], [], []
        for at, some in runs_of(rests):
            term, doc = words_of(some, opens)
            words.append(np.bincount(doc, minlength=len(some)))
            key = np.sort((term >> bits << bits) | (doc + at).astype(U))
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            keys.append(key[first])
            counts.append(np.diff(np.append(first, len(key))).astype(np.int32))
        self.words = np.concatenate(words)
        key, self.tf = np.concatenate(keys), np.concatenate(counts)
        del keys, counts
        order = np.argsort(key, kind="stable")
        key, self.tf = key[order], self.tf[order]
        del order
        self.docs = (key & ((U(1) << bits) - U(1))).astype(np.int32)
        term = key >> bits
        self.begin = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.term = term[self.begin].astype(np.int64)
        self.df = np.diff(np.append(self.begin, len(term)))


class Index:
    """BM25 over one shard.

    ``total`` is the number and ``mean`` the mean length of all documents,
    ``known`` the sorted terms of the shard that several of its documents have
    and ``df`` how many of all documents have each; without them the shard is
    all there is. Terms that many documents of the shard have lie as dense rows.
    ``documents`` are the numbers of those that are scored: all, until ``keep``.
    """

    def __init__(self, p: Postings, total: int = 0, mean: float = 0.0, known: np.ndarray | None = None, df: np.ndarray | None = None):
        n = self.n = p.n
        self.documents = np.arange(n)
        whole = p.df
        if known is not None:
            whole = p.df.copy()
            whole[np.searchsorted(p.term, known)] = df
        total, mean = total or n, mean or float(p.words.mean())
        number = np.repeat(np.arange(len(p.df), dtype=np.int32), p.df)
        idf = np.log1p((total - whole + 0.5) / (whole + 0.5))
        norm = K1 * (1 - B + B * p.words / max(mean, 1))
        self.weight = np.empty(len(number), dtype=np.float32)
        for a in range(0, len(number), RUN):
            run = slice(a, a + RUN)
            self.weight[run] = idf[number[run]] * p.tf[run] * (K1 + 1) / (p.tf[run] + norm[p.docs[run]])
        often = np.flatnonzero(p.df > max(n // DENSE, 1))
        self.row = np.full(len(p.df), -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n), dtype=np.float32)
        at = self.row[number] >= 0
        self.dense[self.row[number[at]], p.docs[at]] = self.weight[at]
        # postings of the other terms that can find a document
        some = (p.df > 1) & (self.row < 0)
        self.df = np.where(some, p.df, 0)
        self.begin = np.cumsum(self.df) - self.df
        self.docs, self.weight = p.docs[some[number]].astype(np.int64), self.weight[some[number]]  # as bincount takes them
        # per document, all its terms that occur elsewhere too
        shared = np.flatnonzero(p.df[number] > 1)
        mine = shared[np.argsort(p.docs[shared].astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
        self.query, self.query_at = number[mine].astype(np.int64), np.searchsorted(p.docs[mine], np.arange(n + 1))

    def keep(self, some: np.ndarray) -> None:
        """From now on only these (a flag for each of ``documents``) are scored, with the same scores; a seed can be any."""
        at = some[self.docs]
        before = np.append(0, np.cumsum(at))
        self.df = before[self.begin + self.df] - before[self.begin]
        self.begin = before[self.begin]
        self.docs, self.weight = (np.cumsum(some) - 1)[self.docs[at]], self.weight[at]
        self.dense = np.compress(some, self.dense, axis=1)
        self.documents = self.documents[some]
        self.n = len(self.documents)

    def scores(self, seed: int) -> np.ndarray:
        """Of each of ``documents``."""
        q = self.query[self.query_at[seed] : self.query_at[seed + 1]]
        row = self.row[q]
        out = np.zeros(self.n, dtype=np.float32)
        for r in row[row >= 0].tolist():
            out += self.dense[r]
        q = q[row < 0]
        if len(q):
            size = self.df[q]
            at = np.repeat(self.begin[q] - np.cumsum(size) + size, size)
            at += np.arange(len(at))
            out += np.bincount(self.docs.take(at), weights=self.weight.take(at), minlength=self.n).astype(np.float32)
        return out


class Router:
    """Leads a document to a leaf of related ones, and tells by sign bits where in the leaf it lies.

    A document is the signed sum, in ``DIMS`` columns, of the weights of its
    words; a word's weight is that of its bucket, by the documents of a bounded
    sample that fill the bucket. Leaves are spherical k-means centres of the sample.
    """

    def __init__(self, rests: list[np.ndarray], opens: np.ndarray, leaves: int):
        self.opens = opens
        self.weight = np.ones(BUCKETS, dtype=np.float32)
        self.centres = np.zeros((1, DIMS), dtype=np.float32)
        rng = np.random.default_rng(1)
        self.planes = rng.choice(np.array([-1, 1], dtype=np.float32), (DIMS, CODE_BITS))
        if not rests or leaves < 2:
            return
        df = np.zeros(BUCKETS, dtype=np.int64)
        for _, some in runs_of(rests):
            term, doc = words_of(some, opens)
            pair = np.unique(doc * BUCKETS + (term >> U(40)).astype(np.int64) % BUCKETS)
            df += np.bincount(pair % BUCKETS, minlength=BUCKETS)
        self.weight = np.log1p((len(rests) - df + 0.5) / (df + 0.5)).astype(np.float32)
        x, _ = self.vectors(rests)
        centres = x[rng.permutation(len(x))[:leaves]]
        for _ in range(ROUNDS):
            leaf = (x @ centres.T).argmax(axis=1)
            total = np.zeros_like(centres)
            np.add.at(total, leaf, x)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            centres = np.where(size > 0, total / np.maximum(size, 1e-9), centres)
        self.centres = centres

    def vectors(self, rests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors, and the number of words."""
        parts = [self._vectors(some) for _, some in runs_of(rests)]
        x, words = (np.concatenate(c) for c in zip(*parts, strict=True))
        return x, words

    def _vectors(self, rests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        term, doc = words_of(rests, self.opens)
        weight = self.weight[((term >> U(40)) & U(BUCKETS - 1)).astype(np.int64)]
        weight = np.where(term & U(1), weight, -weight)
        column = ((term >> U(1)) & U(DIMS - 1)).astype(np.int64)
        x = np.bincount(doc * DIMS + column, weights=weight, minlength=len(rests) * DIMS).reshape(-1, DIMS).astype(np.float32)
        x = np.sign(x) * np.sqrt(np.abs(x))
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), np.bincount(doc, minlength=len(rests))

    def places(self, rests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf, code and number of words of every document."""
        x, words = self.vectors(rests)
        leaf = (x @ self.centres.T).argmax(axis=1)
        bits = (x - self.centres[leaf]) @ self.planes > 0
        return leaf, bits @ (1 << np.arange(CODE_BITS)[::-1]), words


def best_first(score: np.ndarray) -> Iterator[int]:
    """Numbers of all positive scores, best first, ties to the smaller; sorted block by block, as far as they are read."""
    some = np.flatnonzero(score > 0)
    size = 2 * BLOCK
    while len(some):
        value = score[some]
        least = np.partition(value, len(some) - size)[len(some) - size] if len(some) > size else 0
        head = some[value >= least]
        yield from head[np.argsort(-score[head], kind="stable")].tolist()
        some = some[value < least]
        size *= 4


Piece = tuple[int, int, int]  # number of the rest, from, to


def pack(sizes: np.ndarray, index: Index | None, window: int = WINDOW) -> list[list[Piece]]:
    """Sequences of pieces; all but the last few are exactly ``window`` long. The index is left with few documents."""
    n = len(sizes)
    begin = [0] * n
    left = sizes.tolist()
    used = sizes == 0
    out: list[list[Piece]] = []
    cursor, again = 0, -1
    numbers = index.documents.tolist() if index is not None else []

    def take(i: int, most: int) -> int:
        k = min(left[i], most)
        line.append((i, begin[i], begin[i] + k))
        begin[i] += k
        left[i] -= k
        used[i] = left[i] == 0
        return k

    while True:
        while cursor < n and left[cursor] == 0:
            cursor += 1
        seed = again if again >= 0 and left[again] > 0 else cursor
        if seed >= n:
            return out
        if index is not None:
            some = ~used[index.documents]
            if np.count_nonzero(some) < DROP * index.n:
                index.keep(some)
                numbers = index.documents.tolist()
        line: list[Piece] = []
        gap = window - take(seed, window)
        again = -1
        asked = 0
        while gap and index is not None and asked < len(line):
            score = index.scores(line[asked][0])
            asked += 1
            score[used[index.documents]] = 0
            held = []
            for k in best_first(score):
                i = numbers[k]
                if left[i] <= gap:
                    gap -= take(i, gap)
                else:
                    held.append(i)
                if not gap or len(held) >= BLOCK:
                    break
            for i in held:
                if gap:
                    gap -= take(i, gap)
                    again = i
        at = cursor
        while gap and at < n:
            if left[at]:
                gap -= take(at, gap)
                again = at if left[at] else again
            at += 1
        out.append(line)


def powers_of_two(line: list[Piece]) -> list[list[Piece]]:
    """One sequence cut into sequences whose lengths are powers of two."""
    total = sum(b - a for _, a, b in line)
    out: list[list[Piece]] = []
    rest = [list(p) for p in line]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part: list[Piece] = []
        while size:
            i, a, b = rest[0]
            k = min(size, b - a)
            part.append((i, a, a + k))
            size -= k
            if a + k == b:
                rest.pop(0)
            else:
                rest[0][1] = a + k
        out.append(part)
    return out


_MIDDLE = [
    ("leaf", pa.int32()), ("code", pa.int32()), ("salt", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("crc", pa.int64()), ("doc_tokens", pa.int64()), ("words", pa.int64()), ("ids", pa.binary()),
]
_PACKED = ["shard", "doc_id", "tie", "start", "length", "crc", "doc_tokens", "ids"]
_OUT = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
]


def _ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"`{n}` {names[t]}" for n, t in fields)


def _table(fields: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _sampled(docs: DataFrame, n_docs: int, window: int, files: tuple[str, str | None], text_col: str) -> list[np.ndarray]:
    """The rests of about ``SAMPLE`` documents, as token ids: at most 4 bytes a token of a window each."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*files)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids = enc.every(batch.column(0).slice(at, ROWS).to_pylist())
                yield pa.record_batch([pa.array([x[len(x) - len(x) % window :].tobytes() for x in ids], pa.binary())], names=["ids"])

    some = docs.sample(fraction=min(1.0, SAMPLE / n_docs), seed=1).select(text_or_empty(text_col).alias("t"))
    dtype = encoder(*files).dtype
    return [x for x in (np.frombuffer(r.ids, dtype=dtype) for r in some.mapInArrow(tidied(tokenise), "ids binary").collect()) if len(x)]


def placed(
    docs: DataFrame, window: int = WINDOW, shard_docs: int = SHARD_DOCS, files: tuple[str, str | None] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, int, float]:
    """Full pieces and rests with the ``shard`` of each; number of the rests, and their mean length in words."""
    files = files or tokenizer_files()
    json_path, ranks_path = files
    n_docs = docs.count()
    leaves = min(parts_for(n_docs, shard_docs, least=1), LEAVES)
    opens = encoder(json_path, ranks_path).opens
    router = Router(_sampled(docs, n_docs, window, files, text_col) if leaves > 1 else [], opens, leaves)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from rows_of(enc, *(batch.column(i).slice(at, ROWS).to_pylist() for i in range(3)))

    def rows_of(enc: Encoder, doc_ids: list, ties: list, texts: list) -> Iterator[pa.RecordBatch]:
        every = enc.every(texts)
        rests = [ids[len(ids) - len(ids) % window :] for ids in every]
        some = [k for k, r in enumerate(rests) if len(r)]
        leaf, code, words = (np.zeros(len(every), dtype=np.int64) for _ in range(3))
        if some:
            leaf[some], code[some], words[some] = router.places([rests[k] for k in some])
        # repeated rows differ by their place in the batch
        salt = (mix(np.array(ties, dtype=np.int64).view(U) + np.arange(len(ties), dtype=U) * _SPREAD) >> U(1)).astype(np.int64)
        rows = []
        for k, (doc_id, tie, ids) in enumerate(zip(doc_ids, ties, every, strict=True)):
            n, place = len(ids), (int(leaf[k]), int(code[k]), int(salt[k]))
            for at in range(0, n - n % window, window):
                rows.append((*place, doc_id, tie, at, window, crc(ids[at : at + window]), n, 0, None))
            if n % window:
                rows.append((*place, doc_id, tie, n - n % window, n % window, None, n, int(words[k]), rests[k].tobytes()))
        yield from _table(_MIDDLE, rows).to_batches(max_chunksize=10_000)

    tie = F.xxhash64(order_id(id_col), text_or_empty(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), tie.alias("tie"), text_or_empty(text_col).alias("t"))
    rows = staged(rows.mapInArrow(tidied(tokenise), _ddl(_MIDDLE)), "packing")

    rests = rows.filter("ids IS NOT NULL")
    size = rests.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.sum("words").alias("words")).collect()
    total, words = sum(r.n for r in size), sum(r.words for r in size)
    drop = [CODE_BITS] * LEAVES  # of each leaf, the code's bits that its size does not need
    for r in size:
        shards = max(r.n // shard_docs, r.tokens // (shard_docs * SHARD_MEAN), 1)
        drop[r.leaf] = CODE_BITS - min(int(shards).bit_length() - 1, CODE_BITS)
    prefix = F.expr(f"shiftright(code, element_at(array({', '.join(map(str, drop))}), leaf + 1))")
    rows = rows.withColumn("prefix", prefix)
    # at most LEAVES << CODE_BITS cells: 524,288 rows of three numbers, whatever the input
    cells = rows.filter("ids IS NOT NULL").groupBy("leaf", "prefix").agg(
        F.expr(f"greatest(ceil(count(*) / {2 * shard_docs}), ceil(sum(length) / {2 * shard_docs * SHARD_MEAN}))").cast("long").alias("deals")
    )
    deal = F.pmod("salt", F.coalesce("deals", F.lit(1)))
    shard = F.shiftleft(F.col("leaf").cast("long"), CODE_BITS + DEAL_BITS) + F.shiftleft(F.col("prefix").cast("long"), DEAL_BITS) + deal
    return rows.join(F.broadcast(cells), ["leaf", "prefix"], "left").withColumn("shard", shard).select(*_PACKED), total, words / max(total, 1)


def lexical_packing(
    docs: DataFrame, window: int = WINDOW, shard_docs: int = SHARD_DOCS, files: tuple[str, str | None] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    json_path, ranks_path = files or tokenizer_files()
    rows, total, mean = placed(docs, window, shard_docs, files, id_col, text_col)
    enc = encoder(json_path, ranks_path)
    opens, dtype = enc.opens, enc.dtype  # all that the shards need of it

    def ids_of(table: pa.Table) -> list[np.ndarray | None]:
        """Views, no copies."""
        return [np.frombuffer(x.as_buffer(), dtype=dtype) if x.is_valid else None for x in table.column("ids")]

    def count_terms(table: pa.Table) -> pa.Table:
        rests = [x for x in ids_of(table) if x is not None]
        if not rests:
            return pa.table({"shard": pa.array([], pa.int64()), "term": pa.array([], pa.int64()), "df": pa.array([], pa.int64())})
        p = Postings(rests, opens)
        return pa.table({"shard": np.full(len(p.term), table.column("shard")[0].as_py()), "term": p.term, "df": p.df.astype(np.int64)})

    def pack_shard(table: pa.Table, counts: pa.Table) -> pa.Table:
        shard, *columns = (ids_of(table) if c == "ids" else table.column(c).to_pylist() for c in _PACKED)
        rows = sorted(zip(*columns, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        out: list[tuple] = []
        sequence = (shard[0] << SEQUENCE_BITS) if shard else 0
        rests = []
        for doc_id, _, start, length, code, n, ids in rows:
            if ids is None:
                out.append((doc_id, start, length, code, n, sequence, 0))
                sequence += 1
            else:
                rests.append((doc_id, start, n, ids))
        if rests:
            sizes = np.array([len(r[3]) for r in rests])
            known, df = (counts.column(c).to_numpy() for c in ("term", "df"))
            order = np.argsort(known)
            index = Index(Postings([r[3] for r in rests], opens), total, mean, known[order], df[order])
            lines = pack(sizes, index, window)
            full = [x for x in lines if sum(b - a for _, a, b in x) == window]
            partial = [y for x in lines if sum(b - a for _, a, b in x) < window for y in powers_of_two(x)]
            for line in full + partial:
                offset = 0
                for i, a, b in line:
                    doc_id, start, n, ids = rests[i]
                    out.append((doc_id, start + a, b - a, crc(ids[a:b]), n, sequence, offset))
                    offset += b - a
                sequence += 1
        return _table(_OUT, out)

    def counted(table: pa.Table) -> pa.Table:
        out = count_terms(table)
        give_back()
        return out

    def packed(table: pa.Table, counts: pa.Table) -> pa.Table:
        out = pack_shard(table, counts)
        give_back()
        return out

    in_shards = staged(rows.filter("ids IS NOT NULL").groupBy("shard").applyInArrow(counted, "shard long, term long, df long"), "packing-terms")
    # in a query only terms that several documents of the shard have can find one
    asked = in_shards.filter("df > 1").select("shard", "term").join(in_shards.groupBy("term").agg(F.sum("df").alias("df")), "term")
    return rows.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(packed, _ddl(_OUT))
