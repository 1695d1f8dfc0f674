"""BPE merge rounds against the tokenizers library."""

import random

import pytest
from tokenizers import Tokenizer

from tally.llm import bpe_rounds

ODD = ["", " \n", "Hello, it's <|endoftext|> naïve ΣΑΣ İx café", "<|startoftext|><|endoftext|><|end", "we'Ve don't \x1c\x85​ 12³ ⅷ",
       "y" * 5000, "aaa aaaa aaaaa", "qxzj" * 700, "漢字かな 한국어 ١٢٣ \U0001e900\U00010ec2 Ᲊ", "\x00\x7f­͸", "The\tquick\r\nbrown", "'ll'd'" * 9, "ẞ ǅ ﬁ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_rounds.vocabulary_file())


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def same(library, texts):
    encoder = bpe_rounds.Encoder(bpe_rounds.vocabulary(bpe_rounds.vocabulary_file()))
    ids, counts = encoder.encode(texts)
    text = bpe_rounds.decoded(ids, counts, encoder.vocab).to_pylist()
    at = 0
    for t, n, d in zip(texts, counts, text, strict=True):
        assert (ids[at : at + n].tolist(), d) == want(library, t), t[:80]
        at += n


def test_every_known_character_and_random_texts(library):
    known = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and bpe_rounds._KNOWN.fullmatch(chr(c))]
    same(library, [f"a{c}b 1{c}{c} {c}" for c in known])
    rng = random.Random(5)
    same(library, ["".join(rng.choices(known, k=200)) for _ in range(200)])
    same(library, ["".join(rng.choices("aeinrst'<|> .1EÉ́", k=rng.randrange(300))) for _ in range(500)])
    same(library, ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(60)) for _ in range(200)])
    same(library, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))])


def test_long_texts_and_table_limits(library, monkeypatch):
    monkeypatch.setattr(bpe_rounds, "SLICE_CHARS", 40)
    monkeypatch.setattr(bpe_rounds, "TABLE_WORDS", 3)
    encoder = bpe_rounds.Encoder(bpe_rounds.vocabulary(bpe_rounds.vocabulary_file()))
    for t in ODD + ["one two  <|endoftext|> trois é quatre " * 30, "x" * 100 + " " + "́y" * 50]:
        ids, counts = encoder.encode([t, "again " * 9])
        assert ids[: counts[0]].tolist() == want(library, t)[0]


def test_bpe_rows(spark, library):
    rows = [(None, "null id"), (1, None), (2, "two"), (2, "two"), *[(10 + i, t) for i, t in enumerate(ODD)]]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, ids int, decoded string").repartition(3)
    out = bpe_rounds.bpe_encode(docs)
    got = sorted((r.doc_id or -1, r.ids, r.decoded) for r in out.collect())
    assert got == sorted((i or -1, *want(library, t)) for i, t in rows)
    back = sorted((r.doc_id or -1, r.decoded) for r in bpe_rounds.bpe_decode(out).collect())
    assert back == [(i, d) for i, _, d in got]
    assert bpe_rounds.bpe_encode(docs.filter("1 = 0")).count() == 0
    assert bpe_rounds.bpe_decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().decoded == ""


def test_query_on_the_driver_tables(spark, library):
    import hashlib

    from tally.llm.queries import QUERIES

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_bpe_rounds"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids, text = want(library, r.text)
        assert got[r.doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(text))
