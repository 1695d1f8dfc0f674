"""Near-duplicate classes by BagMinHash over multisets of five-word shingles.

Signatures. Each distinct shingle of a document, with its count as weight, is
the source of Poisson processes, one per dyadic block of the weight axis
([0,1), [1,2), [2,4), [4,8), ...) with the block's width as rate. A point has
a time, a signature slot and a cell of its block; it belongs to the document
if its cell lies below the weight. A slot keeps the earliest point. Two
documents agree in a slot with the probability of their weighted Jaccard
similarity. Points come in order of time, and a process stops as soon as its
next point is later than the latest slot, so a document costs about its
shingles plus ``m ln m`` points rather than shingles times ``m``.

Banding and verification. Documents with the same word sequence are first
collapsed into one node. Nodes that share a band are candidates. In each band
bucket the most central node (the one that meets most others over all its
bands; ties by id) is compared with all others by exact multiset overlap;
where that leaves more than one component in a bucket, its next nodes by
centrality (32, then 1024, ...) are compared with those of other
components, and so on until no bucket holds two nodes that were neither
compared nor connected. A shingle that no other node of these buckets has
cannot be part of an overlap, so pairs are passed over whose possible overlap
is too small; that keeps a family of copies just below the threshold from
being compared all with all. So no link within a bucket is lost, copies are never
expanded to pairs, and only nodes that share a band without being connected
are compared with each other. Before the exact comparison, pairs are dropped
whose sketches (one byte a slot) agree in fewer slots than six standard
errors below the threshold. With 30 bands of 5 a pair of similarity 0.8 meets
in a bucket with probability 0.99999.

Skew. The first leaders are minima, pre-aggregated before the shuffle; the
members of one leader are dealt in groups of ``GROUP`` with the leader's
shingles sent to each group. Texts are shuffled once, to the nodes that share
a band with another; their bags of shingles and all tables between are staged
in the shared checkpoint folder.

Defined results: a null or empty text (no word) equals every other such text;
one to four words are a single shingle; a null id is no one's class id unless
all of the class have none; repeated rows each get a row of the same class;
rows that share an id are one document; an empty table gives an empty result;
other columns are dropped by ``near_duplicate_classes`` and kept by
``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._bytes import Spans, U, Words, mix, row_slices, text_bytes
from ._common import MAX_ID, staged, text_or_empty, tidied
from .components import component_labels

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
SLOTS = 600
GROUP, BLOCK = 256, 2048
SIGMAS = 5
NEVER, TICKS = np.iinfo(np.int64).max, 2.0**40
MORE_LEADERS = 32
SLICE_BYTES = 1 << 20
_C = U(0x9E3779B97F4A7C15)
_D = U(0xC2B2AE3D27D4EB4F)


def weighted(shingle: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document: hash, document, count."""
    order = np.lexsort((shingle, doc))
    s, d = shingle[order], doc[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return s[at], d[at], np.diff(np.append(at, len(s)))


def bag_minhash(shingle: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures, ``n_docs`` by ``m``: the time of each slot's first point; ``NEVER`` for a document without shingles.

    Times are whole numbers, so that their sums do not depend on how many
    points are drawn at once, which differs from batch to batch.
    """
    first = np.full(n_docs * m, NEVER)
    # processes: one per shingle and block that begins below its weight
    key, owner, top, low, rate = [mix(shingle)], [doc], [weight], [np.zeros(len(doc))], [np.ones(len(doc))]
    lo, width, block = 1, 1, 1
    more = np.flatnonzero(weight > lo)
    while len(more):
        key.append(mix(shingle[more] + np.full(1, block, dtype=U) * _C))
        owner.append(doc[more])
        top.append(weight[more])
        low.append(np.full(len(more), float(lo)))
        rate.append(np.full(len(more), float(width)))
        lo, block = lo + width, block + 1
        width = lo
        more = more[weight[more] > lo]
    key, owner, top, low, rate = (np.concatenate(x) for x in (key, owner, top, low, rate))
    time = np.zeros(len(key), dtype=np.int64)
    point = 0
    while len(key):
        # a point of each process, or several where few processes are left
        g = max(1, min(64, 50_000 // len(key)))
        r = mix(key[:, None] + (np.arange(point + 1, point + 1 + g, dtype=U) * _D)[None, :])
        u = ((r >> U(11)).astype(np.float64) + 0.5) * 2.0**-53
        times = time[:, None] + np.cumsum((-np.log(u) / rate[:, None] * TICKS).astype(np.int64), axis=1)
        r = mix(r + _C)
        slot = ((r >> U(32)) * U(m)) >> U(32)
        cell = low[:, None] + np.floor((r & U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * rate[:, None])
        mine = cell < top[:, None]
        place = owner[:, None] * m + slot.astype(np.int64)
        np.minimum.at(first, place[mine], times[mine])
        latest = first.reshape(n_docs, m).max(axis=1)
        time = times[:, -1]
        on = time < latest[owner]
        key, owner, top, low, rate, time = (x[on] for x in (key, owner, top, low, rate, time))
        point += g
    return first.reshape(n_docs, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band."""
    bits = np.ascontiguousarray(signature).view(U).reshape(len(signature), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U)), bits.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * _D + bits[:, :, j])
    return key


def sketches(signature: np.ndarray) -> np.ndarray:
    """One byte per slot."""
    return (mix(np.ascontiguousarray(signature).view(U)) >> U(56)).astype(np.uint8)


def likely_pairs(rest: DataFrame, n_leaders: int, threshold: float) -> DataFrame:
    """``(leader, node)`` of ``rest(b, k, node, comp, rank, size, alone, sketch, bands, n)`` that may reach the threshold.

    In each bucket ``b`` (of band ``k``) the nodes of rank ``n_leaders`` or
    less are leaders; they go to every block of the bucket's ``n`` nodes.
    """
    names = ["k", "node", "comp", "rank", "size", "alone", "sketch", "bands"]
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    members = rest.select("b", F.pmod(F.xxhash64("node"), blocks).alias("part"), F.lit(False).alias("leads"), *names)
    leaders = rest.filter(F.col("rank") <= n_leaders).select(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("part"), F.lit(True).alias("leads"), *names
    )

    def compare(table: pa.Table) -> pa.Table:
        leads, node, comp, rank, size, alone = (table.column(c).to_numpy() for c in ("leads", "node", "comp", "rank", "size", "alone"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
        least = threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / sketch.shape[1])
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        before = table.column("k")[0].as_py() if n_leaders > 1 else 0
        pairs = []
        for k in np.flatnonzero(leads):
            overlap = np.minimum(size - alone, size[k] - alone[k])
            at = np.flatnonzero(~leads & (rank > rank[k]) & (comp != comp[k]) & (overlap >= threshold * (size + size[k] - overlap) - 1e-9))
            hit = at[(sketch[at] == sketch[k]).mean(axis=1) >= least]
            hit = hit[~(bands[hit, :before] == bands[k, :before]).any(axis=1)]
            pairs.append((np.full(len(hit), node[k]), node[hit]))
        return pa.table({"leader": np.concatenate([p[0] for p in pairs] or [node[:0]]), "node": np.concatenate([p[1] for p in pairs] or [node[:0]])})

    return members.unionByName(leaders).groupBy("b", "part").applyInArrow(compare, "leader long, node long").distinct()


def sequence_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each document's word sequence."""
    place = (np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.count)).astype(U)
    out = []
    for c in (_C, _D):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(words.hash + place * c))])
        out.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.count.astype(U)))
    return out[0], out[1]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Words]]:
    buf, offsets = text_bytes(batch.column(column))
    for i, j in row_slices(offsets, SLICE_BYTES):
        b, o = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        yield i, j, b, o, Words(b, o, Spans(b))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(values.view(np.int64)))


def node_id(id_col: str, text_col: str) -> Column:
    """The id, or for a null id a number that depends on the text only."""
    return F.coalesce(F.col(id_col).cast("long"), -F.xxhash64(text_or_empty(text_col)).bitwiseAND(MAX_ID) - 1)


def signatures(docs: DataFrame, bands: int, rows: int, slots: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, did, e1, e2, bands, sketch)`` for every row; ``bands`` is empty without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, _, words in _slices(batch, 2):
                s, d, _ = words.shingles(shingle)
                has = words.count > 0
                sig = bag_minhash(*weighted(s, d), j - i, slots)
                keys = band_keys(sig[:, : bands * rows], bands, rows)[has]
                e1, e2 = sequence_keys(words)
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(e1.view(np.int64)),
                     pa.array(e2.view(np.int64)), _lists(keys.ravel(), np.where(has, bands, 0)),
                     pa.array([x.tobytes() for x in sketches(sig)], pa.binary())],
                    names=["doc_id", "did", "e1", "e2", "bands", "sketch"],
                )

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), node_id(id_col, text_col).alias("did"), text_or_empty(text_col).alias("t"))
    return rows_in.mapInArrow(tidied(scan), "doc_id long, did long, e1 long, e2 long, bands array<long>, sketch binary")


def shingle_bags(docs: DataFrame, nodes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(did, bag)`` of ``nodes(did)``: the sorted shingle hashes with their repetitions."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, _, words in _slices(batch, 1):
                s, d, _ = words.shingles(shingle)
                order = np.lexsort((s, d))
                n = np.bincount(d, minlength=j - i)
                s = s[order]
                at = np.concatenate([[0], np.cumsum(n)])
                bag = pa.array([s[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.record_batch([batch.column(0).slice(i, j - i), bag], names=["did", "bag"])

    texts = docs.select(node_id(id_col, text_col).alias("did"), text_or_empty(text_col).alias("t"))
    # one plan at every size: the texts are sorted to the nodes
    return texts.hint("merge").join(nodes, "did", "left_semi").mapInArrow(tidied(bags), "did long, bag binary")


def unshared(bags: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, size, alone)``: the bag's size, and how much of it no other of ``nodes(did)`` has."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for did, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                token, n = np.unique(np.frombuffer(bag, dtype=U), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(token), did)), pa.array(token.view(np.int64)), pa.array(n)], names=["node", "token", "n"])

    own = (
        bags.join(nodes, "did", "left_semi").mapInArrow(tidied(tokens), "node long, token long, n long")
        .groupBy("token").agg(F.count("*").alias("df"), F.min("node").alias("node"), F.sum("n").alias("n"))
        .filter("df = 1").groupBy("node").agg(F.sum("n").alias("alone"))
    )
    sizes = bags.join(nodes, "did", "left_semi").select(F.col("did").alias("node"), (F.octet_length("bag") / 8).cast("long").alias("size"))
    return sizes.join(own, "node", "left").select("node", "size", F.coalesce("alone", F.lit(0)).alias("alone"))


def similar_pairs(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs(leader, node)`` whose bags have a Jaccard similarity of ``threshold`` or more."""
    pairs = staged(pairs.select("leader", "node"), "pairs")
    groups = pairs.groupBy("leader").agg(F.ceil(F.count("*") / GROUP).alias("n"))
    members = pairs.join(groups, "leader").select(
        F.col("node").alias("did"), "leader", F.pmod(F.xxhash64("node"), F.col("n")).cast("long").alias("part")
    )
    leaders = groups.select(F.col("leader").alias("did"), "leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("part"))
    wanted = members.unionByName(leaders)

    def compare(table: pa.Table) -> pa.Table:
        leader = table.column("leader")[0].as_py()
        ids, blobs = table.column("did").to_pylist(), table.column("bag").to_pylist()
        hits: set[int] = set()
        for base in {b for i, b in zip(ids, blobs, strict=True) if i == leader}:
            a, na = np.unique(np.frombuffer(base, dtype=U), return_counts=True)
            size_a = len(base) // 8
            for i, blob in zip(ids, blobs, strict=True):
                size_b = len(blob) // 8
                if i == leader or min(size_a, size_b) < threshold * max(size_a, size_b):
                    continue
                b, nb = np.unique(np.frombuffer(blob, dtype=U), return_counts=True)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                both = int(np.minimum(na[at], nb)[a[at] == b].sum()) if len(a) else 0
                if both >= threshold * (size_a + size_b - both) - 1e-9:
                    hits.add(i)
        return pa.table({"u": pa.array(sorted(hits), pa.int64()), "v": pa.array([leader] * len(hits), pa.int64())})

    return (
        bags.hint("merge").join(wanted, "did")
        .select("leader", "part", "did", "bag")
        .groupBy("leader", "part")
        .applyInArrow(compare, "u long, v long")
    )


def near_duplicate_classes(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, slots: int = SLOTS, shingle: int = SHINGLE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, did, class_id, first)``: one row per row of ``docs``.

    ``class_id`` is the smallest id of the class, ``did`` the row's node id
    and ``first`` the node id of the class's smallest document.
    """
    sig = staged(signatures(docs, bands, rows, slots, shingle, id_col, text_col), "signatures")
    nodes = staged(sig.groupBy("e1", "e2").agg(F.min("did").alias("node")), "nodes")
    member = sig.join(nodes, ["e1", "e2"])
    banded = member.filter(F.col("did") == F.col("node")).select("node", F.posexplode("bands").alias("k", "b"))
    sizes = banded.groupBy("b").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = staged(banded.join(staged(sizes, "buckets"), "b"), "bucket-members")
    central = staged(buckets.groupBy("node").agg((-F.sum("size")).alias("s")), "centrality")
    buckets = buckets.join(central, "node").select("b", "k", "node", "s")
    candidates = central.select(F.col("node").alias("did"))
    sketched = staged(sig.join(candidates, "did", "left_semi").dropDuplicates(["did"]).select(
        F.col("did").alias("node"), "sketch", "bands", F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("alone")
    ), "sketches")
    bags = staged(shingle_bags(docs, candidates, shingle, id_col, text_col), "bags")
    edges = docs.sparkSession.createDataFrame([], "u long, v long")
    labels = edges
    n_leaders = 1
    while True:
        placed = buckets.join(labels.withColumnsRenamed({"u": "node", "v": "comp"}), "node", "left").select(
            "b", "k", "node", "s", F.coalesce("comp", "node").alias("comp")
        )
        mixed = placed.groupBy("b").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct("s", "node")).alias("first"), F.count("*").alias("n")
        ).filter("lo < hi").select("b", "first", "n")
        rest = placed.join(staged(mixed, "mixed-buckets"), "b")
        if n_leaders == 1:
            rank = F.when(F.col("node") == F.col("first.node"), 1).otherwise(2).cast("int")
        else:
            rank = F.row_number().over(Window.partitionBy("b").orderBy("s", "node"))
        rest = staged(rest.withColumn("rank", rank).select("b", "k", "node", "s", "comp", "rank", "n"), "bucket-rest")
        if rest.isEmpty():
            break
        if n_leaders == MORE_LEADERS:
            limits = unshared(bags, rest.select(F.col("node").alias("did")).distinct())
            sketched = staged(limits.join(sketched.drop("size", "alone"), "node"), "limits")
        found = similar_pairs(likely_pairs(rest.join(sketched, "node"), n_leaders, threshold), bags, threshold)
        edges = staged(edges.unionByName(found), "links")
        labels = component_labels(edges)
        buckets = rest.filter(F.col("rank") > n_leaders).select("b", "k", "node", "s")
        n_leaders *= MORE_LEADERS
    member = member.select("doc_id", "did", "node").join(labels.withColumnsRenamed({"u": "node", "v": "comp"}), "node", "left")
    member = staged(member.select("doc_id", "did", F.coalesce("comp", "node").alias("comp")), "membership")
    first = staged(
        member.groupBy("comp").agg(
            F.min("doc_id").alias("class_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "did")).alias("f"),
        ).select("comp", "class_id", F.col("f.did").alias("first")),
        "classes",
    )
    return member.join(first, "comp").select("doc_id", "did", "class_id", "first")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every class, the one with the smallest id, all columns as they are."""
    classes = near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **options)
    keep = staged(classes.select(F.col("first").alias("_did")).distinct(), "kept-documents")
    rows = docs.select(F.struct("*").alias("_row"), node_id(id_col, text_col).alias("_did"))
    kept = rows.join(keep, "_did", "left_semi").dropDuplicates(["_did"])
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
