"""MinHash near-dedup with tensored banding: documents whose sets of word n-grams overlap enough.

A table's key has to consist of several minhashes to be selective, and there have to be many tables to miss little; each with minhashes of its own would take tables x width of them. Here two
small collections of `HALF` half keys, each of `WIDTH` minhashes, are all that is computed. Every pair of one half key from either collection is a table key:
HALF x HALF tables of 2 x WIDTH minhashes from 2 x HALF x WIDTH, about twice the square root of what independent tables would take. Two sets of similarity s share a key unless none of
their half keys agree in one of the collections: they are found with a chance of (1 - (1 - s^WIDTH)^HALF)^2, 99.98 % at the least similarity of 80 %, more than 99.999 % at 85 %.

1. One pass takes each document's set of distinct n-grams (hashed to 64 bits): its size, a 128-bit digest, `BITS` parities (of how many n-grams fall on each of so many places), and
   the half keys. Equal sets are one class from here on.
2. A half key that only one class has can't be part of a shared table key. So classes meet under their half keys first, and only those that are shared in both collections go on,
   with the half keys that are shared: 2 x HALF rows a document at most, however many others share them.
3. Classes meet under first halves and agree in a table key if they have a second half in common. As an n-gram that only one of two sets has changes one parity, sets whose parities differ in too
   many places can't be similar enough; with the sizes that rules out nearly all pairs that don't link, exactly. Tasks sort first halves of up to `GROUP` classes and keep a class under a half if
   sizes and parities allow a partner there; larger ones stay whole.
4. Pairs come from the halves that are left (see `linking`); a crowded one is split into its table keys, the pairs of it and each second half. They are verified once on the n-grams of
   the whole texts. The connected groups are the result.

Words: A-Z lower-cased, runs of anything but \\x20 and \\x09-\\x0D. A text with fewer than `n` words is one n-gram; null and empty texts have none and link with nothing. Rows are
documents: rows that repeat an id with the same text are alike, with another text they are documents of their own. Null ids get their set size, no links and a null component, and
are kept. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.linking import linked
from millrace.llm.ngram_join import PARTS, _digest, _verifier
from millrace.llm.shared import discard, identified, light, written
from millrace.llm.words import LOWER, Words, chunks, grams, mixed

N, PERCENT = 2, 80
HALF, WIDTH, BITS = 14, 3, 512
#: Pairs a class that a half may leave to the parities before it is split.
CROWD = 4_096
#: Classes of a half that one task compares; pairs of them at a time; classes that all others of a half are held against first.
GROUP, PAIRS, SOME = 16_384, 1 << 20, 64
_SALTS = mixed(np.arange(1, 2 * HALF * WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def half_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of 2 * HALF half keys for each set; `first`: where the sets begin, none of them empty. A set may hold an n-gram more than once."""
    out = np.zeros((2 * HALF, len(first)), np.uint64)
    for k, salt in enumerate(_SALTS):
        own = (hashes ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
        own ^= own >> np.uint64(32)
        own *= np.uint64(0xC4CEB9FE1A85EC53)
        out[k // WIDTH] = mixed(out[k // WIDTH] + np.minimum.reduceat(own, first) + salt)
    return out.T


def _first_pass(docs: DataFrame, n: int) -> DataFrame:
    """(id, row, size, d1, d2, parts, bits, halves) from (id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, data, off in chunks(b.column(2)):
                w = Words(LOWER[data], off)
                hashes = w.hashes()
                whole, full = grams(hashes, n), np.flatnonzero(w.count > 0)
                sets = [whole[s : e - n + 1] if e - s >= n else grams(hashes[s:e], int(e - s)) for s, e in zip(w.first[full].tolist(), w.first[full + 1].tolist(), strict=True)]
                halves = np.zeros((y - x, 2 * HALF), np.int64)
                size, marks, parts = np.zeros(y - x, np.int64), np.zeros((y - x, 2), np.int64), np.zeros((y - x, PARTS), np.int32)
                bits = np.zeros((y - x, BITS // 64), np.int64)
                if sets:
                    halves[full] = half_keys(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))).view(np.int64)
                for i, own in zip(full.tolist(), sets, strict=True):
                    own = np.unique(own)
                    size[i], marks[i], parts[i] = len(own), _digest(own), np.bincount((own >> np.uint64(61)).astype(np.int64), minlength=PARTS)
                    bits[i] = np.packbits(np.bincount((own & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).view(np.int64)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1]).cast(pa.list_(pa.array(v.ravel()[:0]).type)) for v in (parts, bits, halves)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), b.column(1).slice(x, y - x), pa.array(size), pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy()), *lists], ["id", "row", "size", "d1", "d2", "parts", "bits", "halves"])

    return docs.mapInArrow(run, "id bigint, row bigint, size bigint, d1 bigint, d2 bigint, parts array<int>, bits array<bigint>, halves array<bigint>")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of (key, node) whose key another node has too. A hot key's rows need not meet in one task."""
    keys = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    return rows.join(keys, "key", "left_semi")


def with_partner(sizes: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Of the sets of one group, whether sizes and parities (a row of words for each) allow another one to be similar enough."""
    n, found = len(sizes), np.zeros(len(sizes), bool)

    def held_against(rows: np.ndarray, others: np.ndarray) -> None:
        for a in range(0, len(rows), max(1, PAIRS // max(1, len(others)))):
            i = rows[a : a + max(1, PAIRS // max(1, len(others)))]
            x, y = sizes[i, None], sizes[None, others]
            apart = np.zeros((len(i), len(others)), np.int64)
            for k in range(bits.shape[1]):
                apart += np.bitwise_count(bits[i, None, k] ^ bits[None, others, k])
            fits = (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (apart * (100 + percent) <= (100 - percent) * (x + y))
            fits &= i[:, None] != others[None, :]
            found[i] |= fits.any(1)
            found[others] |= fits.any(0)

    every = np.arange(n)
    held_against(every, every[:: max(1, n // SOME)])
    held_against(np.flatnonzero(~found), every)
    return found


def _sifted(keyed: DataFrame, places: list[str], percent: int) -> DataFrame:
    """Rows of (key, node, size, *places, left, right) that may have a partner under their key. Keys of more than `GROUP` rows stay whole, and in no one's memory."""
    many = written(keyed.groupBy("key").count().where(F.col("count") > GROUP).select("key"))
    names, partitions = keyed.columns, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        order = np.argsort(rows.column("key").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        key, sizes = rows.column("key").to_numpy(), rows.column("size").to_numpy()
        bits = np.column_stack([rows.column(p).to_numpy().view(np.uint64) for p in places])
        first = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
        keep = np.zeros(len(key), bool)
        for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if z - a > 1:
                keep[a:z] = with_partner(sizes[a:z], bits[a:z], percent)
        yield from rows.filter(pa.array(keep)).to_batches(max_chunksize=10_000)

    if many.isEmpty():
        return keyed.repartition(partitions, "key").mapInArrow(run, keyed.schema)
    few = keyed.join(many, "key", "left_anti").select(*names)
    return few.repartition(partitions, "key").mapInArrow(run, keyed.schema).unionByName(keyed.join(many, "key", "left_semi").select(*names))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """For each row of `docs`: id, n_shingles, component_id (the smallest id that links lead to, its own included), kept (whether it is that id itself)."""
    texts = identified(docs, id_col, text_col)
    sets = written(_first_pass(texts, n))
    same = F.struct("d1", "d2", "size")
    best = F.min(F.struct("id", "row")).alias("first")
    # a class is named by half of its digest
    classes = written(sets.where("id is not null and size > 0").groupBy("d1", "d2", "size").agg(best, F.first("parts").alias("parts"), F.first("bits").alias("bits"), F.first("halves").alias("halves")).withColumn("node", F.col("d1")))

    halves = written(_shared(classes.select("node", F.explode("halves").alias("key"))))
    # a class's half keys are 2 * HALF at most, so a group is small
    kept = halves.groupBy("node").agg(F.collect_set("key").alias("kept"))
    places = [f"p{i}" for i in range(BITS // 64)]
    sides = classes.join(kept, "node").select(
        "node", "size", *[F.col("bits")[i].alias(p) for i, p in enumerate(places)],
        F.array_intersect(F.slice("halves", 1, HALF), "kept").alias("left"), F.array_intersect(F.slice("halves", HALF + 1, HALF), "kept").alias("right"),
    )
    sides = written(sides.where((F.size("left") > 0) & (F.size("right") > 0)))
    keyed = written(sides.select(F.explode("left").alias("key"), "node", "size", *places, "left", "right"))
    halved, keyed = keyed, written(_sifted(keyed, places, percent))
    discard(halved)

    of_nodes = written(classes.join(keyed.select("node").distinct(), "node", "left_semi").select("node", "size", "parts", "first"))
    wanted = of_nodes.select("node", F.col("first.row").alias("row"), F.col("first.id").alias("id"))
    candidates = written(texts.join(light(wanted, F.lit(3)), ["id", "row"]).groupBy("node").agg(F.first("text").alias("text")))

    def fits(x: str, y: str):
        xs, ys = F.col(f"{x}.size"), F.col(f"{y}.size")
        apart = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in places), F.lit(0))
        # d n-grams that only one of the sets has leave an overlap of (x + y - d) / 2
        near = (100 * F.least(xs, ys) >= percent * F.greatest(xs, ys)) & (apart * (100 + percent) <= (100 - percent) * (xs + ys))
        return near & F.arrays_overlap(F.col(f"{x}.right"), F.col(f"{y}.right"))

    def once(x: str, y: str):
        return F.element_at(F.array_intersect(F.col(f"{x}.left"), F.col(f"{y}.left")), 1) == F.col("key")

    marks = sides.select("node", F.explode("right").alias("mark"))
    groups = linked(keyed, _verifier(candidates, of_nodes.drop("first"), n, percent), fits, ["size", *places, "left", "right"], marks, CROWD, once)
    for table in (keyed, candidates, of_nodes, halves, sides):
        discard(table)
    of_classes = classes.select(same.alias("set"), "node", "first").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = of_classes.groupBy("component").agg(F.min("first.id").alias("component_id"))
    of_classes = of_classes.join(lowest, "component").select("set", "component_id")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return (
        sets.select("id", "size", same.alias("set"))
        .join(of_classes, "set", "left")
        .select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
    )
