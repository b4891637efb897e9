"""N-gram Jaccard join: documents whose sets of word n-grams overlap enough, by rare-first prefix filtering.

1. One pass takes each document's set of distinct n-grams (hashed to 64 bits), its size and a 128-bit digest, and counts n-grams over all documents in a table
   of `SLOTS` counters. Equal sets are one class from here on, its smallest id stands for it.
2. The n-grams of a set are put in order, rare first: by counter, then by hash. Two sets of sizes x and y that are similar enough share one of
   the first x - ceil(t x) + 1 and y - ceil(t y) + 1. Only these prefixes are shuffled. A counter is never below the number of documents with its n-gram, so
   a group with a counter below `HOT` has fewer rows than that and is checked in one task; n-grams above it count as shared without a check.
3. Pairs come from shared prefix n-grams (see `linking`), pass the length and the positional filter there, then the suffix filter: sets are cut in `PARTS` parts by hash,
   and what the sizes of the parts differ by bounds the overlap from above. What is left is verified once, on the exact n-grams of the texts, next to a
   leader whose members are split into runs of `RUN`.

   A crowded n-gram is split by the other n-grams of the prefix and the next one after it: similar sets share two of those, so no link is lost.

Words: A-Z lower-cased, runs of anything but \\x20 and \\x09-\\x0D. A text with fewer than `n` words is one n-gram; null and empty texts have none and link with nothing.
Rows that repeat an id with the same text are the same document, with another text a document of its own; null ids get their set size, no links and a null component. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.linking import linked
from millrace.llm.shared import discard, identified, light, written
from millrace.llm.words import LOWER, Words, chunks, grams, mixed

N, PERCENT = 4, 85
SLOTS, PART, HOT, PARTS, RUN = 1 << 19, 1 << 14, 50_000, 8, 1_000


def _sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of every row."""
    for a, z, data, off in chunks(texts):
        w = Words(LOWER[data], off)
        hashes = w.hashes()
        all_grams = grams(hashes, n)
        for i in range(z - a):
            s, e = w.first[i], w.first[i + 1]
            if e - s >= n:
                yield a + i, np.unique(all_grams[s : e - n + 1])
            else:
                yield a + i, grams(hashes[s:e], int(e - s)) if e > s else np.empty(0, np.uint64)


def _digest(keys: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that don't depend on order; each n-gram is mixed anew for either."""
    with np.errstate(over="ignore"):
        return tuple(int(mixed(keys ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for salt in (0x51ED270B, 0xA5A5F00D))


def _first_pass(docs: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: (id, row, size, d1, d2, parts) of documents (id, row, text), and (part, counts) of the counters of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SLOTS, np.int64)
        schema = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("size", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("parts", pa.list_(pa.int32())), ("part", pa.int32()), ("counts", pa.binary())])
        for b in batches:
            out = []
            for _, keys in _sets(b.column(2), n):
                np.add.at(counters, (keys & np.uint64(SLOTS - 1)).astype(np.int64), 1)
                out.append((len(keys), *_digest(keys), np.bincount((keys >> np.uint64(61)).astype(np.int64), minlength=PARTS).tolist()))
            size, d1, d2, parts = zip(*out, strict=True) if out else ((), (), (), ())
            none = [None] * len(out)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(parts, pa.list_(pa.int32())), pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=schema)
        full = [k for k in range(SLOTS // PART) if counters[k * PART : (k + 1) * PART].any()]
        none = [None] * len(full)
        body = [counters[k * PART : (k + 1) * PART].astype(np.uint32).tobytes() for k in full]
        yield pa.RecordBatch.from_arrays([*(pa.array(none, t) for t in schema.types[:6]), pa.array(full, pa.int32()), pa.array(body, pa.binary())], schema=schema)

    return docs.mapInArrow(run, "id bigint, row bigint, size bigint, d1 bigint, d2 bigint, parts array<int>, part int, counts binary")


def _counters(rows: DataFrame) -> np.ndarray:
    """Sum of the counters of all tasks; `SLOTS` numbers come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "counts"])

    out = np.zeros(SLOTS, np.int64)
    for r in rows.select("part", "counts").repartition(SLOTS // PART, "part").mapInArrow(add, "part int, counts binary").collect():
        out[r.part * PART : (r.part + 1) * PART] = np.frombuffer(r.counts, np.int64)
    return out


def _needed(size: np.ndarray | int, percent: int):
    """Least overlap of a set of this size with one that is similar enough."""
    return -(-size * percent // 100)


def _prefixes(docs: DataFrame, shared, n: int, percent: int) -> DataFrame:
    """(key, node, size, place, spare, hot) of the prefix n-grams, and of the next one (spare). Sets so small that not even one n-gram more keeps them similar have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            ids, rows, keys_, nodes, sizes, places, spare, hot = b.column(0).to_pylist(), b.column(1).to_pylist(), [], [], [], [], [], []
            for row, keys in _sets(b.column(2), n):
                size = len(keys)
                take = size - int(_needed(size, percent)) + 1
                if ids[row] is None or (take < 2 and size * 100 // percent == size):
                    continue
                count = table[(keys & np.uint64(SLOTS - 1)).astype(np.int64)]
                rank = (count << np.uint64(44)) | (keys >> np.uint64(20))
                first = np.argsort(rank, kind="stable")[: take + 1]
                keys_.append(keys[first].view(np.int64))
                hot.append(count[first] >= HOT)
                nodes.append(np.full(len(first), rows[row]))
                sizes.append(np.full(len(first), size))
                places.append(np.arange(len(first)))
                spare.append(np.arange(len(first)) >= take)
            if keys_:
                columns = [pa.array(np.concatenate(c)) for c in (keys_, nodes, sizes, places, spare, hot)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "size", "place", "spare", "hot"])

    return docs.mapInArrow(run, "key bigint, node bigint, size bigint, place bigint, spare boolean, hot boolean")


def _verifier(candidates: DataFrame, sets: DataFrame, n: int, percent: int):
    """`candidates`: (node, text) and `sets`: (node, size, parts) of all nodes that share a key."""

    def verify(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("size").alias("x"), F.col("parts").alias("p"))
        right = sets.select(F.col("node").alias("b"), F.col("size").alias("y"), F.col("parts").alias("q"))
        apart = F.aggregate(F.zip_with("p", "q", lambda i, j: F.abs(i - j)), F.lit(0), lambda s, d: s + d)
        # sets that differ in d n-grams at least share (x + y - d) / 2 at most; enough is overlap * (100 + t) >= t * (x + y)
        kept = pairs.join(left, "a").join(right, "b").where((F.col("x") + F.col("y") - apart) * (100 + percent) >= 2 * percent * (F.col("x") + F.col("y"))).select("a", "b")
        crowd = kept.groupBy("a").agg(F.ceil(F.count("*") / RUN).alias("runs"))
        members = kept.join(crowd, "a").select("a", F.pmod(F.xxhash64("b"), F.col("runs")).alias("run"), F.col("b").alias("node"))
        leaders = crowd.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("runs") - 1)).alias("run"), F.col("a").alias("node"))
        texts = members.unionByName(leaders).join(candidates, "node")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, lead = None, frozenset()
            for b in batches:
                found = []
                for a, part, node, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    words = text.encode().lower().split()
                    own = frozenset(zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else frozenset([tuple(words)])
                    if node == a:
                        at, lead = (a, part), own
                    elif at == (a, part):
                        both = len(own & lead)
                        if 100 * both >= percent * (len(own) + len(lead) - both):
                            found.append((a, node))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        rows = texts.select("a", "run", "node", "text").repartition("a", "run").sortWithinPartitions("a", "run", F.col("node") != F.col("a"))
        return rows.mapInArrow(run, "a bigint, b bigint")

    return verify


def _small(percent: int) -> int:
    """Sets of this size or less may link though one n-gram is all they share."""
    return (100 // percent) * 100 // percent


def _groups(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, row, n_shingles, component_id) of documents (id, row, text)."""
    sc = docs.sparkSession.sparkContext
    first = written(_first_pass(docs, n))
    sets = first.where("part is null").drop("part", "counts")
    same = F.struct("d1", "d2", "size")
    real = sets.where("id is not null and size > 0")
    # the smallest id of a class, and the row that stands for it
    classes = written(real.groupBy("d1", "d2", "size").agg(F.min(F.struct("id", "row")).alias("least"), F.first("parts").alias("parts")).withColumn("node", F.col("least.row")))
    shared = sc.broadcast(np.minimum(_counters(first.where("part is not null")), (1 << 20) - 1).astype(np.uint64))
    prefixes = _prefixes(docs, shared, n, percent)
    of_key = Window.partitionBy("key")
    cold = prefixes.where("not hot").withColumn("n", F.count("*").over(of_key)).withColumn("real", F.count_if(~F.col("spare")).over(of_key))
    together = cold.where("n > 1").withColumn("lone", F.col("real") < 2).drop("n", "real").unionByName(prefixes.where("hot").withColumn("lone", F.lit(False)))
    together = written(together.drop("hot").join(classes.select("node"), "node", "left_semi"))
    shared.destroy()
    keyed = together.where("not spare and not lone").select("key", "node", "size", "place")
    small = together.where(F.col("size") <= _small(percent)).select("node", F.lit(0).cast("bigint").alias("mark"))
    marks = together.select("node", F.col("key").alias("mark")).unionByName(small)
    nodes = keyed.select("node").distinct()
    of_nodes = written(classes.join(nodes, "node", "left_semi").select("node", "least.id", "size", "parts"))
    wanted = of_nodes.select("id", F.col("node").alias("row"))
    candidates = written(docs.join(light(wanted, F.lit(2)), ["id", "row"]).groupBy(F.col("row").alias("node")).agg(F.first("text").alias("text")))

    def fits(x: str, y: str):
        xs, ys = F.col(f"{x}.size"), F.col(f"{y}.size")
        length = (100 * F.least(xs, ys)) >= percent * F.greatest(xs, ys)
        most = 1 + F.least(xs - F.col(f"{x}.place") - 1, ys - F.col(f"{y}.place") - 1)
        return length & (most * (100 + percent) >= percent * (xs + ys))

    groups = linked(keyed, _verifier(candidates, of_nodes.drop("id"), n, percent), fits, ["size", "place"], marks)
    for table in (together, of_nodes, candidates):
        discard(table)
    labelled = classes.join(groups, "node", "left").select(same.alias("set"), F.coalesce("component", "node").alias("component"), "least.id")
    lowest = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    labelled = labelled.join(lowest, "component").select("set", "component_id")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return sets.select("id", "row", "size", same.alias("set")).join(labelled, "set", "left").select("id", "row", F.col("size").alias("n_shingles"), component.alias("component_id"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """For each row of `docs`: id, n_shingles, component_id (the smallest id that links lead to, its own included)."""
    return _groups(identified(docs, id_col, text_col), n, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """Rows of `docs` but for documents that link to one with a smaller id, all columns as they are; rows that repeat an id and its text go or stay together. Null ids stay."""
    gone = written(_groups(identified(docs, id_col, text_col), n, percent).where("component_id < id").select(F.col("row").alias("_row")).distinct())
    return docs.join(light(gone, F.lit(1)), F.xxhash64(docs[id_col].cast("bigint"), docs[text_col]) == gone["_row"], "left_anti")
