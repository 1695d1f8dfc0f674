"""Merkle manifests against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tally.llm import merkle_manifest as M

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain(leaves):
    """Root, and each leaf's proof as (place, siblings)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    proofs = []
    for i in range(len(leaves)):
        steps, at = [], i
        for level in levels[:-1]:
            run = at // 8 * 8
            steps.append((at % 8, "".join(level[run:at] + level[at + 1 : run + 8])))
            at //= 8
        proofs.append(steps)
    return levels[-1][0], proofs


def brute(rows):
    """(group, order, leaf) -> [(order, leaf, subroot, root, steps)]."""
    groups = {}
    for g, i, leaf in rows:
        groups.setdefault("" if g is None else "=" + g, []).append((i is not None, i or 0, leaf))
    order = sorted(groups, key=str.encode)
    trees = {g: plain([x[2] for x in sorted(groups[g])]) for g in order}
    root, tops = plain([trees[g][0] for g in order])
    return sorted(
        (has, i, leaf, trees[g][0], root, steps + top)
        for g, top in zip(order, tops, strict=True)
        for (has, i, leaf), steps in zip(sorted(groups[g]), trees[g][1], strict=True)
    )


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, None: 1}, {"é": 9, "z": 700, None: 65, "": 3, "=": 8}, {f"g{i}": 1 + i % 3 for i in range(80)}, {"hot": 5000, "b": 512}])
def test_proofs(spark, sizes):
    rows = [(g, i * 7 % 10007, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "grp string, pos long, digest string").withColumn("steps", F.lit("clash")).repartition(5)
    manifest = M.merkle_manifest(df, "digest", "grp", ["pos"])
    out = manifest.proofs()
    assert out.columns == ["grp", "pos", "digest", "subroot", "root", "steps"]
    got = out.withColumn("end", M.folded(F.col("digest"), F.col("steps"))).withColumn("text", M.proof_text(F.col("steps"))).collect()
    assert sorted((True, r.pos, r.digest, r.subroot, r.root, [(s.at, s.siblings) for s in r.steps]) for r in got) == brute(rows)
    assert all(r.end == r.root and r.text == "".join(s.siblings for s in r.steps) for r in got)
    assert {r.group: r.n_rows for r in manifest.subroots().collect()} == sizes


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, None, sha("x")), (None, None, sha("a")), ("l", 1, sha("b")), ("l", 1, sha("b")), ("l", 1, sha("a")), ("l", None, sha("c"))]
    df = spark.createDataFrame(rows, "lang string, doc_id long, digest string")
    got = M.merkle_manifest(df, "digest", "lang", ["doc_id"]).proofs().collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.digest, r.subroot, r.root, [(s.at, s.siblings) for s in r.steps]) for r in got) == brute(rows)
    none = M.merkle_manifest(df.filter("1 = 0"), "digest", "lang", ["doc_id"])
    assert none.root == sha("") and none.proofs().count() == 0 and none.subroots().count() == 0


def test_only_every_third_level_is_stored(spark):
    df = spark.range(5000).select(F.lit("a").alias("g"), "id", F.sha2(F.col("id").cast("string"), 256).alias("d"))
    assert [x.count() for x in M.merkle_manifest(df, "d", "g", ["id"]).levels] == [5000, 10, 1]


def test_row_digest(spark):
    r = spark.sql("select cast(null as long) a, 'é:' b, -12 c, '' d").select(M.row_digest(*[F.col(c) for c in "abcd"]).alias("h")).first()
    assert r.h == sha("-3:é:3:-120:")


def test_query_on_the_driver_tables(spark):
    from tally.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(enc(r.doc_id) + enc(r.source) + enc(r.lang) + enc(r.n_chars) + enc(text))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = {x[1]: x for x in brute([(r.lang, r.doc_id, leaf(r, r.text)) for r in rows])}
    got = {r.doc_id: r for r in QUERIES["op12_merkle_manifest"](spark, sf).collect()}
    assert len(got) == len(rows)
    n_bad = 0
    for r in rows:
        _, _, digest, subroot, root, steps = want[r.doc_id]
        shown = digest
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None:
            shown = leaf(r, r.text.translate(lower))
        end = shown
        for at, text in steps:
            end = sha(text[: 64 * at] + end + text[64 * at :])
        n_bad += end != root
        assert tuple(got[r.doc_id]) == (r.doc_id, digest, subroot, root, sha("".join(t for _, t in steps)), end, end == root)
    assert 0 < n_bad < len(rows)
