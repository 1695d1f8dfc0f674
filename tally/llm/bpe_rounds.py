"""BPE encoding and decoding by batched merge rounds.

A task cuts its texts into words as the vocabulary file says (canonical
composition, small letters, the file's pattern) and looks each word up in a
table of words met before; only new words are merged, all those of a slice
together. Their symbols lie in one flat array. A round finds the rank of every
adjacent pair by binary search over the sorted pair keys, takes the lowest
rank of each unit (a word, or less: see below), merges that pair wherever it
stands in the unit, leftmost first, and lets finished units go. A word is cut
into units wherever two neighbouring bytes stand side by side in no token, as
no merge can cross such a place; so long words take few rounds. Decoding looks
ids up in the token list and joins them.

No shuffle: one pass over the texts. Memory is bounded: texts are taken in
slices, long ones in pieces that end before a space (which no word crosses),
and the word table starts anew beyond ``TABLE_WORDS`` words or ``TABLE_CHARS``
letters. A hot source or group of copies costs each of its texts one lookup a
word. The vocabulary file must lie at the same path on every executor; its
size does not follow the data.

Defined results: a null or empty text has no ids and decodes to an empty
text; repeated rows and null ids stay as they are; an empty table gives an
empty result; the strings of added tokens in a text are those tokens, as the
library takes them; columns other than the id and the text are dropped, so no
name can clash. Characters outside ``_KNOWN`` may be classed differently by
two Unicode versions, so texts with such characters are cut by the tokenizers
library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import text_or_empty

SLICE_CHARS = 1 << 20
TABLE_WORDS = 300_000
TABLE_CHARS = 16_000_000
NONE = np.int64(1 << 62)

# Fixed value: the word pattern of the vocabulary file, and the same for plain ASCII.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = regex.compile(PATTERN)
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_KNOWN = re.compile(r"[\x00-ɏ̀-ͯΆ-ώЀ-ԯḀ-ỿ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*")


def vocabulary_file() -> str:
    """The default vocabulary: BPE with word ends, in small letters."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """Pair keys, ranks and products of a vocabulary file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        cut = spec["pre_tokenizer"]["pretokenizers"][0]
        if cut["pattern"]["Regex"] != PATTERN or model["dropout"] or not end or spec["decoder"]:
            raise ValueError(f"not a word-end vocabulary of the known kind: {path}")
        ids: dict[str, int] = model["vocab"]
        self.size = max(ids.values()) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        product = np.array([ids[a + b] for a, b in merges], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.product = key[order], order.astype(np.int64), product
        # a product that an earlier rule takes further would need one merge at a time
        first_use = np.full(self.size, len(merges))
        np.minimum.at(first_use, np.concatenate([left, right]), np.tile(np.arange(len(merges)), 2))
        if (first_use[product] <= np.arange(len(merges))).any():
            raise ValueError(f"merge rules out of order: {path}")

        letters = byte_letters()
        self.byte = {c: b for b, c in enumerate(letters)}
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.final = np.array([ids[c + end] for c in letters], np.int64)
        self.beside = np.zeros((256, 512), dtype=bool)  # byte, then byte (last of a word: + 256)
        for token in ids:
            base = [self.byte[c] for c in token.removesuffix(end)]
            if token.endswith(end):
                base[-1] += 256
            for a, b in zip(base, base[1:], strict=False):
                self.beside[a, b] = True

        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"added tokens of an unknown kind: {path}")
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        names = {i: t for t, i in (ids | self.added).items()}
        self.tokens = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        self.path = path
        self._library = None

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def words(self, text: str) -> list[str]:
        """The words of a text; an added token is a word of its own."""
        if self.split and "<" in text and (parts := self.split.split(text))[1:]:
            return [w for p in parts for w in ([p] if p in self.added else self._cut(p))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII_WORDS.findall(text.lower())
        if _KNOWN.fullmatch(text):
            return _WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        lib = self.library()
        found = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, w)).decode() for w, _ in found]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        at = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        end = np.cumsum(size) - 1
        sym = self.inner[at]
        sym[end] = self.final[at[end]]
        at[end] += 256
        start = np.ones(len(sym), dtype=bool)  # a unit begins here
        if len(sym) > 1:
            before = at[:-1] & 255
            start[1:] = ~self.beside[before, at[1:]]
            start[end[:-1] + 1] = True
        place = np.arange(len(sym))  # of each symbol's first byte
        done_sym, done_place = [], []
        while len(sym):
            rank = np.full(len(sym), NONE)
            key = sym[:-1] * self.size + sym[1:]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[found] == key) & ~start[1:]
            rank[:-1][ok] = self.ranks[found[ok]]
            first = np.flatnonzero(start)
            width = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            low = np.repeat(least, width)
            over = low == NONE
            done_sym.append(sym[over])
            done_place.append(place[over])
            hit = np.flatnonzero((rank == low) & ~over)
            if len(hit):  # of overlapping places (a a a) every second one, from the left
                fresh = np.ones(len(hit), dtype=bool)
                fresh[1:] = np.diff(hit) > 1
                run = np.maximum.accumulate(np.where(fresh, hit, 0))
                hit = hit[(hit - run) % 2 == 0]
                sym[hit] = self.product[rank[hit]]
            keep = ~over
            keep[hit + 1] = False
            sym, place, start = sym[keep], place[keep], start[keep]
        place = np.concatenate(done_place) if done_place else np.zeros(0, np.int64)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        order = np.argsort(place, kind="stable")
        word = np.searchsorted(end, place[order])
        return sym[order].astype(np.int32), np.bincount(word, minlength=len(words))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder(dict):
    """Words met so far, numbered; a missing word gets the next number and waits for the next merge."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.flat = np.fromiter(self.vocab.added.values(), np.int32, len(self.vocab.added))
        self.count = np.ones(len(self.flat), np.int64)
        for word in self.vocab.added:
            self[word] = len(self)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        if len(self) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self._reset()
        words = [[w for p in pieces(t) for w in self.vocab.words(p)] if len(t) > SLICE_CHARS else self.vocab.words(t) for t in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((n for ws in words for n in map(self.__getitem__, ws)), np.int64, int(n_words.sum()))
        if self.new:
            ids, count = self.vocab.merged(self.new)
            self.flat = np.concatenate([self.flat, ids])
            self.count = np.concatenate([self.count, count])
            self.chars += sum(map(len, self.new))
            self.new = []
        start = np.cumsum(self.count) - self.count
        size = self.count[at]
        stop = np.cumsum(size)
        out = self.flat[np.repeat(start[at] - (stop - size), size) + np.arange(int(size.sum()))]
        return out, np.diff(np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(n_words)])])


def pieces(text: str) -> Iterator[str]:
    """A long text in pieces that begin at a space; no word or added token crosses one."""
    i = 0
    while i < len(text):
        j = text.find(" ", i + SLICE_CHARS)
        j = len(text) if j < 0 else j
        yield text[i:j]
        i = j


def decoded(ids: np.ndarray, counts: np.ndarray, vocab: Vocabulary) -> pa.Array:
    """The text of each run of ids: its tokens, joined by spaces."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), vocab.tokens.take(pa.array(ids))), " ")


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    i, size = 0, 0
    for j, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    encoder = Encoder(vocab)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for i, j in _slices(texts):
            ids, counts = encoder.encode(texts[i:j])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, decoded(ids, counts, vocab)], ["id", "ids", "decoded"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    for batch in batches:
        lists = batch.column(1)
        counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        yield pa.RecordBatch.from_arrays([batch.column(0), decoded(np.asarray(lists.flatten()), counts, vocab)], ["id", "decoded"])


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: the id, the token ids of the whole text, and those ids decoded again."""
    path, kind = path or vocabulary_file(), docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(lambda batches: _encode(batches, path), f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def bpe_decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row: the id and the text of its token ids; null ids decode to an empty text."""
    path, kind = path or vocabulary_file(), rows.schema[id_col].dataType.simpleString()
    out = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return out.mapInArrow(lambda batches: _decode(batches, path), f"id {kind}, decoded string").withColumnRenamed("id", id_col)
