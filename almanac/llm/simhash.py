"""SimHash near-dedup by a self-join of binary tries.

Documents with equal fingerprints fall together first, so the join sees each fingerprint
once. Two fingerprints within two bits agree on one of three blocks of the 64 bits; so there
are three tries, each over the bits rotated to bring one block to the top, and their top
nodes (equal blocks) are dealt over the cluster. Below, pairs of nodes are traversed together
level by level: children with unlike bits add one to the differing bits, and a pair beyond
the error budget is pruned with all below it. Top nodes with very many fingerprints are first
split into the node pairs some levels further down, each for a task of its own.

Links become components by alternating large-star and small-star rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import cut
from .sizes import fresh

BUDGET, SHINGLE, SEED = 2, 3, 42
#: Rotation and length of each trie's top block; BUDGET + 1 blocks make 64 bits.
TOPS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints in a top node beyond which it is split, by how many further bits, and rounds of splitting.
NODE_LIMIT, STEP, ROUNDS = 20_000, 10, 4
#: Rows of one task's group of nodes.
GROUP_ROWS = 100_000
#: Texts whose bits are counted at once, 2,048 counters each.
TEXTS_AT_ONCE = 1024
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def fingerprint_texts(column: pa.Array) -> np.ndarray:
    """The SimHash of each text as uint64: a bit is 1 if it is in over half of the shingles' hashes."""
    import xxhash

    h, hashes, counts = xxhash.xxh64_intdigest, [], np.zeros(len(column), np.int64)
    for i, t in enumerate(column):
        w = t.as_buffer().to_pybytes().lower().split()
        if not w:
            continue
        j = b" ".join(w)
        if len(w) <= SHINGLE:
            hashes.append(h(j, SEED))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = [0, *ends[: len(w) - SHINGLE].tolist()]
        hashes += [h(j[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]
        counts[i] = len(w) - SHINGLE + 1
    if not hashes:
        return np.zeros(len(column), np.uint64)
    lanes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    key = np.repeat(np.arange(len(column)) * 2048, counts)[:, None] + np.arange(8) * 256 + lanes
    by_byte = np.bincount(key.ravel(), minlength=len(column) * 2048).reshape(-1, 256).astype(np.float64)
    ones = (by_byte @ _BITS).reshape(len(column), 64)
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp as a signed long, text_key) of every row; a null text has fingerprint 0."""
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = tx.plain(b.column(1))
            for i, j in tx.pieces(column, 2 << 20, TEXTS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(fingerprint_texts(column.slice(i, j - i)).view(np.int64)), b.column(2).slice(i, j - i)], ["doc_id", "fp", "text_key"])
        tx.trim()

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, text_key long")


def trie_pairs(v: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], budget: int = BUDGET, top: int = min(n for _, n in TOPS)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``budget`` differing bits, from node pairs (ranges of v; within a range v is sorted and distinct).

    A range is a trie node: its values share the bits above. A range against itself is one
    node paired with itself. The ``top`` highest bits are known to be equal.
    """
    work = [(a[0], a[1], b[0], b[1], np.zeros(len(a[0]), np.int8), 63 - top)]
    ones: dict[int, np.ndarray] = {}
    while work:
        al, ah, bl, bh, err, bit = work.pop()
        if len(al) > 2_000_000:  # bounded temporaries: the halves go on their own
            m = len(al) // 2
            work += [(al[:m], ah[:m], bl[:m], bh[:m], err[:m], bit), (al[m:], ah[m:], bl[m:], bh[m:], err[m:], bit)]
            continue
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any():
            i, j = al[leaf], bl[leaf]
            ok = (i != j) & (np.bitwise_count(v[i] ^ v[j]) <= budget)
            yield i[ok], j[ok]
            al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
        if not len(al) or bit < 0:
            continue
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((v >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        c = ones[bit]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        other = al != bl
        nxt = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1), tuple(x[other] for x in (am, ah, bl, bm, err + 1))]
        al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*nxt, strict=True))
        keep = (al < ah) & (bl < bh) & (err <= budget) & ~((al == bl) & (ah - al == 1))
        work.append((*(x[keep] for x in (al, ah, bl, bh, err)), bit - 1))


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each of n items' component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _join_nodes(table: pa.Table) -> pa.Table:
    """Links among the fingerprints of a group of node pairs, as (u, v): a fingerprint and one it is connected to."""
    rot, cell, side, v = (table.column(c).to_numpy() for c in ("rot", "cell", "side", "v"))
    v = v.view(np.uint64)
    order = np.lexsort((v, side, cell))
    rot, cell, side, v = rot[order], cell[order], side[order], v[order]
    lo = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (side[1:] != side[:-1]))))
    hi = np.append(lo[1:], len(v))
    own = (side[lo] == 0) & (hi - lo > 1)
    first = np.flatnonzero((side[lo[:-1]] == 1) & (cell[lo[:-1]] == cell[lo[1:]])) if len(lo) > 1 else np.zeros(0, np.int64)
    a = np.concatenate((lo[own], lo[first])), np.concatenate((hi[own], hi[first]))
    b = np.concatenate((lo[own], lo[first + 1])), np.concatenate((hi[own], hi[first + 1]))
    found = list(trie_pairs(v, a, b))
    i, j = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    shift = np.array([r for r, _ in TOPS], np.uint64)[rot]
    fp = np.where(shift == 0, v, (v >> shift) | (v << (np.uint64(64) - shift) % np.uint64(64))).view(np.int64)
    names, index = np.unique(fp, return_inverse=True)
    root = roots(len(names), index[i], index[j])
    linked = np.flatnonzero(root != np.arange(len(names)))
    return pa.table({"u": names[linked], "v": names[root[linked]]})


def _rotl(x: Column, r: int) -> Column:
    return x if r == 0 else F.shiftleft(x, r).bitwiseOR(F.shiftrightunsigned(x, 64 - r))


def _split(cells: DataFrame, depth: int) -> DataFrame:
    """Each row's node pairs STEP levels below ``depth``: its own node with each node in reach of the budget."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= BUDGET]
    p = F.shiftrightunsigned("v", 64 - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1))
    q = p.bitwiseXOR(F.col("mask"))
    left = F.when(F.col("side") == 1, p).when(F.col("side") == 2, q).otherwise(F.least(p, q))
    right = F.when(F.col("side") == 1, q).when(F.col("side") == 2, p).otherwise(F.greatest(p, q))
    side = F.when(F.col("side") != 0, F.col("side")).when(F.col("mask") == 0, 0).when(p < q, 1).otherwise(2)
    return cells.withColumn("mask", F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))).select("rot", F.xxhash64("cell", left, right).alias("cell"), side.cast("int").alias("side"), "v")


def links(distinct: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (u, v) that connect all fingerprints within the budget; ``distinct`` has each fp once."""
    tops = F.array(*(F.struct(F.lit(k).alias("rot"), _rotl(F.col("fp"), r).alias("v"), F.xxhash64(F.lit(k), F.shiftrightunsigned(_rotl(F.col("fp"), r), 64 - n)).alias("cell")) for k, (r, n) in enumerate(TOPS)))
    cells = distinct.select(F.inline(tops)).select("rot", "cell", F.lit(0).alias("side"), "v")
    ready, depth = [], min(n for _, n in TOPS)
    for _ in range(ROUNDS):
        full = cells.groupBy("cell").count().where(F.col("count") > node_limit).select(F.col("cell").alias("full"))
        if full.isEmpty():
            break
        held = cells.join(full, F.col("cell") == F.col("full"), "left")
        ready.append(held.where("full IS NULL").drop("full"))
        cells, depth = cut(_split(held.where("full IS NOT NULL").drop("full"), depth)), depth + STEP
    for more in ready:
        cells = cells.unionByName(more)
    n_groups = max(64, math.ceil(3 * distinct.count() / GROUP_ROWS))
    grouped = cells.withColumn("g", F.pmod(F.xxhash64("cell", F.lit("g")), F.lit(n_groups)).cast("int"))
    return grouped.groupBy("g").applyInArrow(lambda t: _join_nodes(t), "u long, v long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, root) for every node of ``edges`` but the roots: root is the least node of its component.

    Large-star and small-star rounds in turn, each cut off by a checkpoint, until nothing
    changes. The least neighbour is a sum-like aggregate and the join on it an equi-join, so a
    node with very many links is no single task's work.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    def star(both: DataFrame, keep: Column) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        return both.join(least, F.col("u") == F.col("w")).where(keep).select("u", "v", "m")

    old = state(edges)
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = star(down, F.lit(True))
        edges = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = state(edges)
        if new == old:
            return edges.select("u", F.col("v").alias("root"))
        old = new
    raise RuntimeError("components did not settle")


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, fp, text_key, root, component_id) of every row; root names the component."""
    fps = cut(fingerprints(docs, id_col, text_col))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    comp = components(links(distinct.select("fp"), node_limit))
    rooted = distinct.join(comp, F.col("fp") == F.col("u"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least_id")
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return fps.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest id reachable over links.

    A null or blank text has fingerprint 0 and links like any other. A null id is never the
    smallest; a component of null ids alone has a null component_id. Repeated rows share a
    component, and rows of one id with unlike texts are judged apart. A very long text is a batch
    of its own. An empty table gives none; other columns are dropped.
    """
    return labelled(docs, id_col, text_col, node_limit).select("doc_id", "fp", "component_id")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, of equal ids the one with the smaller text hash.

    Null, empty and very long texts link by their fingerprints like any other. Rows without an id
    stay; a repeated row stays once. Two rows of one id and unlike texts are two documents. An
    empty table gives none; other columns stay as they are, whatever their names.
    """
    own, of_id, of_key = (fresh(docs, x) for x in ("_text_key", "_of_id", "_of_key"))
    first = labelled(docs, id_col, text_col).where("doc_id IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    keep = first.select(F.col("first.doc_id").alias(of_id), F.col("first.text_key").alias(of_key))
    known = docs.where(F.col(id_col).isNotNull()).withColumn(own, F.xxhash64(F.col(text_col).cast("string")))
    kept = known.join(keep, (F.col(id_col) == F.col(of_id)) & (F.col(own) == F.col(of_key)), "left_semi").dropDuplicates([id_col, own])
    return kept.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
