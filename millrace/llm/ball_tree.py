"""Ranked lexical search: for each item the highest-scoring of all documents, exactly, by inner products pruned with ball trees.

A document is a sparse vector with one whole number for each of its terms, the term's share of the score; an item is the set of its terms. The score is their inner product.
1. Items are taken in blocks of at most `BLOCK` bytes and `ITEMS` items, each against all documents. A block's terms are sent to the tasks.
2. One pass over the texts counts documents and terms and writes each document's vector, cut to the terms of the block; inner products with its items don't change by that. Documents
   without any of them can't score. Frequencies of terms are counted over that table.
3. Each task packs its vectors into ball trees of `CHUNK` documents. For the bounds the terms are dealt to `GROUPS` groups (each term its own if there are no more than that), and a
   document is as long in a group as its vector's part there; by Cauchy and Schwarz no inner product is lost by that. A node holds the centroid of its documents, the radius around it,
   and the radius in each group. An item's inner product with any document below a node is at most the smaller of `q c + |q| radius` and the sum of
   `q_g (c_g + radius_g)`. Centroids and radii are 32-bit floats, so bounds are raised by more than their rounding (`SAFE`); scores are whole numbers.
4. An item goes through a tree best bound first and leaves it as soon as the best bound is below its threshold, the score of its `top`-th best document so far. At a leaf the
   scores of its documents are added up in 64-bit integers. Thresholds start from the `top`-th best of a share of the documents, looked at first; it is a score that
   `top` documents reach, so nothing is lost, and few documents more than those of the result leave the tasks, however many tasks there are.
5. What the tasks keep is ranked by score, then id.

Terms are runs of letters, digits and non-ASCII, only A-Z lower-cased; they are known by 64-bit hashes. Rows of `docs` are documents: one that is repeated is counted and listed as often.
Null and empty texts have no terms. A null id comes last among equal scores. Rows of `items` that repeat an id with the same text are one item, with another text they are items of
their own under the same id. Items without a known term have no rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.llm.shared import discard, written
from millrace.llm.words import LETTERS, LOWER, Words, chunks

TOP = 50
BLOCK, ITEMS = 8 << 20, 4_096
CHUNK, LEAF, GROUPS, SKETCH = 1_024, 16, 4_096, 64
#: Entries of a tree at most, unless one document has more. One document of so many is looked at first.
ENTRIES, SHARE = 1 << 20, 16
#: Relative slack of a bound; 32-bit sums of some thousand values are off by less than a tenth of it.
SAFE = 1e-3


def _terms(texts: pa.Array) -> Iterator[tuple[int, Words, np.ndarray]]:
    """(first row, words, their hashes) of runs of rows."""
    for a, _, data, off in chunks(texts):
        w = Words(LOWER[data], off, LETTERS)
        yield a, w, w.hashes()


def _vectors(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Rows of two kinds: (id, n, terms, counts) of documents with a known term, terms as places in `known`; (docs, total) of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("docs", pa.int64()), ("total", pa.int64())])
        terms, full, total = shared.value, 0, 0
        for b in batches:
            for a, w, hashes in _terms(b.column(1)):
                full, total = full + int((w.count > 0).sum()), total + len(hashes)
                at = np.searchsorted(terms, hashes)
                hit = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == hashes) if len(terms) else np.empty(0, np.int64)
                pairs, counts = np.unique(w.row[hit] * len(terms) + at[hit], return_counts=True)
                rows, first = np.unique(pairs // max(1, len(terms)), return_index=True)
                cuts = pa.array(np.append(first, len(pairs)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in ((pairs % max(1, len(terms))).astype(np.int32), counts.astype(np.int64))]
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows + a)), pa.array(w.count[rows].astype(np.int64)), *lists, none, none], schema=schema)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in schema.types[:4]), pa.array([full], pa.int64()), pa.array([total], pa.int64())], schema=schema)

    found = written(docs.mapInArrow(run, "id bigint, n bigint, terms array<int>, counts array<bigint>, docs bigint, total bigint"))
    shared.destroy()
    return found


class BallTree:
    """Documents as rows of a sparse matrix of whole numbers, in the order of the tree's leaves. Node k has the children 2k + 1 and 2k + 2; leaves are the last level."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int):
        """Row i has `values` at `terms` from first[i] to first[i + 1], at least one; `size`: number of terms."""
        n = len(first) - 1
        self.groups = min(size, GROUPS)
        row = np.repeat(np.arange(n), np.diff(first))
        depth = max(0, math.ceil(math.log2(n / LEAF))) if n else 0
        self.order, cuts = self._split(row, terms, values, n, depth)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        by = np.argsort(place[row], kind="stable")
        self.terms, self.values = terms[by], values[by]
        self.first = np.concatenate(([0], np.cumsum(np.diff(first)[self.order])))
        self.leaves, self.inner = cuts, (1 << depth) - 1
        weights = values.astype(np.float64) ** 2
        squares = np.bincount(place[row] * self.groups + terms % self.groups, weights=weights, minlength=n * self.groups)
        self._bounds(np.sqrt(squares, out=squares).astype(np.float32).reshape(n, self.groups), np.bincount(place[row], weights=weights, minlength=n))

    @staticmethod
    def _split(row: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the rows and where leaves begin: halves along the line between two far rows, seen in a sketch of few dimensions."""
        mixed = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        sign = np.where(mixed >> np.uint64(63), 1.0, -1.0)
        seen = np.bincount(row * SKETCH + ((mixed >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64), weights=sign * values, minlength=n * SKETCH).reshape(n, SKETCH)
        order, cuts = np.arange(n), [0, n]
        for _ in range(depth):
            after = [0]
            for a, z in zip(cuts, cuts[1:], strict=False):
                own = seen[order[a:z]]
                one = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
                other = own[((own - one) ** 2).sum(1).argmax()]
                order[a:z] = order[a:z][np.argsort(own @ (one - other), kind="stable")]
                after += [(a + z) // 2, z]
            cuts = after
        return order, np.array(cuts)

    def _bounds(self, x: np.ndarray, norms: np.ndarray) -> None:
        """Of all nodes, as columns: centroid, and centroid and radius by group; and the radius. `norms`: squares of the lengths of the rows of `x`."""
        nodes = 2 * self.inner + 1
        self.centre, self.upper, self.radius = np.zeros((self.groups, nodes), np.float32), np.zeros((self.groups, nodes), np.float32), np.zeros(nodes)
        if not len(x):
            return
        cuts, at = self.leaves, self.inner
        most, least, total = (f.reduceat(x, cuts[:-1]) for f in (np.maximum, np.minimum, np.add))
        while True:
            c = total / np.diff(cuts)[:, None].astype(np.float32)
            to = slice(at, at + len(c))
            self.centre[:, to], self.upper[:, to] = c.T, (c + np.maximum(most - c, c - least)).T
            long = (c.astype(np.float64) ** 2).sum(1)
            for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                # the square is a difference of sums, so its rounding is measured by theirs
                self.radius[at + k] = math.sqrt(max(0.0, (norms[a:z] - 2.0 * (x[a:z] @ c[k]) + long[k]).max() + SAFE * (norms[a:z].max() + long[k])))
            if at == 0:
                break
            most, least, total = np.maximum(most[::2], most[1::2]), np.minimum(least[::2], least[1::2]), total[::2] + total[1::2]
            cuts, at = cuts[::2], (at - 1) // 2

    def limits(self, item: np.ndarray) -> np.ndarray:
        """For each node no less than the inner product of any of its documents with the terms of `item`."""
        groups, number = np.unique(item % self.groups, return_counts=True)
        q = np.sqrt(number).astype(np.float32)
        in_groups = q @ self.upper[groups]
        in_ball = q @ self.centre[groups] + math.sqrt(len(item)) * self.radius
        return np.minimum(in_groups, in_ball) * (1 + SAFE) + 1

    def scores(self, leaf: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their scores) of a leaf; `wanted`: of each term whether the item has it."""
        a, z = self.leaves[leaf], self.leaves[leaf + 1]
        s, e = self.first[a], self.first[z]
        return self.order[a:z], np.add.reduceat(np.where(wanted[self.terms[s:e]], self.values[s:e], 0), self.first[a:z] - s)

    def search(self, item: np.ndarray, wanted: np.ndarray, threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of leaf after leaf, best bound first, until the best bound is below `threshold()`."""
        limits = self.limits(item)
        heap = [(-float(limits[0]), 0)]
        while heap and -heap[0][0] >= threshold():
            _, node = heapq.heappop(heap)
            if node >= self.inner:
                yield self.scores(node - self.inner, wanted)
                continue
            for child in (2 * node + 1, 2 * node + 2):
                heapq.heappush(heap, (-float(limits[child]), child))


def _best(vectors: DataFrame, shared: Broadcast, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, id, score): of each item and task the `top` best documents that reach the item's floor. `shared`: weights of the terms, the items' terms and floors."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, BallTree]]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            terms, counts = b.column(2), b.column(3)
            off = terms.offsets.to_numpy().astype(np.int64)
            t, f, n, ids = terms.values.to_numpy(), counts.values.to_numpy(), b.column(1).to_numpy(), b.column(0).to_pylist()
            m = np.repeat(50 + 50 * n * n_docs // n_terms, np.diff(off))
            f = f[off[0] : off[-1]]
            value = shared.value[0][t[off[0] : off[-1]]] * (1_000_000_000 * f // (1_000 * f + 20 * m))
            a = 0
            while a < len(ids):
                left = ENTRIES - size
                z = min(len(ids), a + CHUNK - len(held), max(a + (not held), int(np.searchsorted(off, off[a] + left, "right")) - 1))
                for i in range(a, z):
                    held.append((ids[i], t[off[i] : off[i + 1]], value[off[i] - off[0] : off[i + 1] - off[0]]))
                size, a = size + int(off[z] - off[a]), z
                if a < len(ids) or len(held) >= CHUNK:
                    yield built(held)
                    held, size = [], 0
        if held:
            yield built(held)

    def built(held: list[tuple]) -> tuple[list, BallTree]:
        first = np.concatenate(([0], np.cumsum([len(x) for _, x, _ in held])))
        return [i for i, _, _ in held], BallTree(first, np.concatenate([x for _, x, _ in held]), np.concatenate([v for _, _, v in held]), len(shared.value[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked, floor = shared.value
        heaps: list[list[tuple]] = [[] for _ in asked]
        wanted = np.zeros(len(weights), bool)
        for ids, tree in trees(batches):
            for k, item in enumerate(asked):
                heap, low = heaps[k], int(floor[k])
                threshold = lambda: heap[0][0] if len(heap) == top else low  # noqa: B023, E731
                wanted[item] = True
                for rows, scores in tree.search(item, wanted, threshold) if len(item) else ():
                    for i in np.flatnonzero(scores >= threshold()).tolist():
                        name = ids[rows[i]]
                        entry = (int(scores[i]), name is not None, -(name or 0))
                        if len(heap) < top:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                wanted[item] = False
        found = [(k, -i if real else None, s) for k, heap in enumerate(heaps) for s, real, i in heap]
        for a in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found[a : a + 10_000], strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "id", "score"])

    return vectors.select("id", "n", "terms", "counts").mapInArrow(run, "item int, id bigint, score bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search(docs: DataFrame, block: list[Row], top: int) -> DataFrame:
    """(item: place in `block`, rank, id, score)."""
    spark = docs.sparkSession
    found = [np.unique(own) for _, w, hashes in _terms(pa.array([r.text for r in block], pa.string())) for own in np.split(hashes, w.first[1:-1])]
    known = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
    table = _vectors(docs, known)
    n_docs, n_terms = table.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    vectors = table.where("docs is null")
    weights = np.zeros(len(known), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    places = [np.searchsorted(known, h) for h in found]
    items = [p[weights[p] > 0] for p in places]
    floors = np.ones(len(items), np.int64)
    for share in (vectors.where(F.pmod(F.xxhash64("id", "n"), F.lit(SHARE)) == 0), vectors):
        shared = spark.sparkContext.broadcast((weights, items, floors))
        best = written(_ranked(_best(share, shared, n_docs, n_terms, top), top))
        shared.destroy()
        if share is vectors:
            break
        for r in best.where(F.col("rank") == top).select("item", "score").collect():
            floors[r["item"]] = r["score"]
        discard(best)
    discard(table)
    return best


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP
) -> DataFrame:
    """(item id, rank from 1, document id, score) of the `top` best documents of each item that score above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.bytes // BLOCK), -(-size.n // ITEMS))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    kind = asked.schema["item_id"].dataType
    names = f"`{item_col}` {kind.simpleString()}, rank int, `{id_col}` bigint, score bigint"
    out = spark.createDataFrame([], names)
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if block:
            named = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"item int, item_id {kind.simpleString()}")
            best = _search(texts, block, top).join(F.broadcast(named), "item")
            out = out.unionByName(best.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    return out
