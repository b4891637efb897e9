"""Cut a table at exact ranks without sorting it.

A split needs to know only a few boundary keys: "the n-th smallest key". They are
found by counting key prefixes (a few thousand counts per pass) and descending into
the prefix that holds the wanted rank, so the only shuffles are of tiny count tables and
the membership column is then a plain per-row comparison. Rows tied on a boundary key
are told apart by a hash of the whole row; rows that are equal in every column are
interchangeable and are counted, not ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, quoted, row_hash

STEPS = (3, 2, 1)  # characters a prefix may grow by in one pass
LEVEL_ROWS = 100_000  # prefix counts wanted on the driver per pass
FINISH_BELOW = 20_000  # rows or distinct keys left under the open prefixes before keys are listed
CROWDED = 0.05
EXPAND_CHUNK = 1_000_000
MANY_GROUPS = 1_000  # from here on ranks are counted in Spark, group by group; the result is the same
NULL_GROUP = "\u0000"
ALL_ROWS = ""


@dataclass(frozen=True)
class Cut:
    """``rank`` rows lie before the cut; ``below`` of them have a key under ``key``."""

    rank: int
    key: str
    below: int
    ties: int

    @property
    def splits_ties(self) -> bool:
        return self.below < self.rank < self.below + self.ties


def _group_code(group: str | None) -> Column:
    if group is None:
        return F.lit(ALL_ROWS)
    return F.coalesce(col(group).cast("string"), F.lit(NULL_GROUP))


def sortable_key(df: DataFrame, columns: Sequence[str]) -> tuple[Column, int]:
    """Fixed-width text that sorts like the given integer, date or time columns."""
    parts, width = [], 0
    exprs = []
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            exprs.append(col(name).cast("bigint"))
        elif isinstance(kind, T.DateType):
            exprs.append(F.datediff(col(name), F.lit("1970-01-01")).cast("bigint"))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            exprs.append(F.unix_micros(col(name).cast("timestamp")))
        else:
            raise ValueError(f"cannot order by {name}: {kind.simpleString()}")
    bounds = df.agg(
        *[F.min(e).alias(f"lo{i}") for i, e in enumerate(exprs)],
        *[F.max(e).alias(f"hi{i}") for i, e in enumerate(exprs)],
    ).first()
    for i, e in enumerate(exprs):
        low, high = bounds[f"lo{i}"] or 0, bounds[f"hi{i}"] or 0
        digits = len(str(high - low))
        shifted = (e - F.lit(low)).cast("string")
        # nulls last: '~' sorts after every digit
        parts.append(F.coalesce(F.lpad(shifted, digits, "0"), F.lit("~" * digits)))
        width += digits
    return F.concat(*parts), width


def locate_cuts(
    df: DataFrame,
    key: Column,
    width: int,
    plan: Callable[[dict[str, int]], dict[str, list[int]]],
    group: str | None = None,
) -> dict[str, list[Cut]]:
    """Find the cuts that ``plan`` asks for, given the row count of each group."""
    frame = df.select(_group_code(group).alias("g"), key.alias("o"))

    def under(parents: set[tuple[str, str]]) -> DataFrame:
        if not parents:
            return frame
        depth = len(next(iter(parents))[1])
        wanted = [g + "\u0001" + p for g, p in parents]
        return frame.where(F.concat("g", F.lit("\u0001"), F.substring("o", 1, depth)).isin(wanted))

    def distinct_under(parents: set[tuple[str, str]]) -> int:
        return under(parents).agg(F.approx_count_distinct("o").alias("d")).first()["d"]

    def histogram(length: int, parents: set[tuple[str, str]]) -> dict[tuple[str, str], int]:
        rows = under(parents)
        counted = rows.groupBy("g", F.substring("o", 1, length).alias("p")).count()
        return {(r["g"], r["p"]): r["count"] for r in counted.collect()}

    def step(parents: int) -> int:
        return next((s for s in STEPS if parents * 16**s <= LEVEL_ROWS), STEPS[-1])

    length = min(STEPS[0] if group is None else STEPS[1], width)
    level = histogram(length, set())
    sizes: dict[str, int] = {}
    for (g, _), n in level.items():
        sizes[g] = sizes.get(g, 0) + n

    done: dict[str, list[Cut]] = {}
    open_cuts: list[dict] = []
    for g, ranks in plan(sizes).items():
        done[g] = []
        for rank in ranks:
            if rank <= 0:
                done[g].append(Cut(rank, "", 0, 0))
            elif rank >= sizes[g]:
                done[g].append(Cut(rank, "￿", sizes[g], 0))
            else:
                open_cuts.append({"g": g, "rank": rank, "prefix": "", "below": 0, "size": sizes[g]})

    while open_cuts:
        children: dict[tuple[str, str], list[tuple[str, int]]] = {}
        depth = len(open_cuts[0]["prefix"])
        for (g, p), n in level.items():
            children.setdefault((g, p[:depth]), []).append((p, n))
        for kids in children.values():
            kids.sort()
        crowded = False  # a prefix kept far more rows than an even spread would leave it
        for cut in open_cuts:
            parent_size = cut["size"]
            for p, n in children[(cut["g"], cut["prefix"])]:
                if cut["below"] + n >= cut["rank"]:
                    cut["prefix"], cut["size"] = p, n
                    break
                cut["below"] += n
            crowded = crowded or cut["size"] > parent_size * CROWDED
        if length >= width:
            for cut in open_cuts:
                done[cut["g"]].append(Cut(cut["rank"], cut["prefix"], cut["below"], cut["size"]))
            break
        parents = {(c["g"], c["prefix"]): c["size"] for c in open_cuts}
        few_left = sum(parents.values()) <= FINISH_BELOW
        if crowded and not few_left:
            few_left = distinct_under(set(parents)) <= FINISH_BELOW
        length = width if few_left else min(length + step(len(parents)), width)
        level = histogram(length, set(parents))
    for cuts in done.values():
        cuts.sort(key=lambda c: c.rank)
    return done


def _passed(key: Column, cuts: list[Cut]) -> Column:
    """How many cuts lie before a row whose key is not split by any of them."""
    total = F.lit(0)
    for cut in cuts:
        total = total + (key > F.lit(cut.key)).cast("int")
    return total


def _expand_equal_rows(
    df: DataFrame, key: Column, cuts: dict[str, list[Cut]], group: str | None, out: str
) -> DataFrame:
    """Number all rows under one order key from the counts of the fully equal ones, in parallel chunks."""
    columns = df.columns
    counted = df.groupBy(*[col(c) for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    # different rows under one key are as rare as equal digests; still, each starts where the one before ends
    before = Window.partitionBy(_group_code(group), key).orderBy(F.xxhash64(*[col(c) for c in columns])).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_start", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    chunks = counted.select(
        "*",
        F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {EXPAND_CHUNK}"))
        ).alias("_chunk"),
    ).repartition("_chunk", *[col(c) for c in columns])
    start = F.col("_chunk") * EXPAND_CHUNK
    stop = F.least(start + EXPAND_CHUNK, F.col("_copies")) - 1
    copies = chunks.select("*", F.explode(F.sequence(start, stop)).alias("_copy"))
    member = F.lit(None).cast("int")
    for g, group_cuts in cuts.items():
        for h in {c.key for c in group_cuts if c.splits_ties}:
            total = F.lit(0)
            for c in group_cuts:
                if c.key == h and c.splits_ties:
                    total = total + (F.col("_copy") + F.col("_start") + F.lit(c.below) >= F.lit(c.rank)).cast("int")
                else:
                    total = total + (key > F.lit(c.key)).cast("int")
            member = F.when((_group_code(group) == F.lit(g)) & (key == F.lit(h)), total).otherwise(member)
    return copies.withColumn(out, member).select(*[col(c) for c in columns], out)


def _ranked(df: DataFrame, out: str, order: Column, group: str, table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Membership for any number of groups: nothing about single groups reaches the driver.

    Rows are counted by group and key prefix (4,096 of them), so a row's rank is the count of the prefixes before plus its place inside
    its own, and even a group with a third of all rows is ranked in thousands of windows."""
    rows = df.withColumn("_g", _group_code(group)).withColumn("_o", order).withColumn("_p", F.substring("_o", 1, 3))
    counts = rows.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    cuts = table(counts.groupBy("_g").agg(F.sum("_n").alias("n"))).select("_g", "_cuts")
    inside = Window.partitionBy("_g", "_p").orderBy("_o", row_hash(sorted(df.columns)))
    ranked = rows.join(offsets, ["_g", "_p"]).withColumn("_rank", F.col("_before") + F.row_number().over(inside)).join(cuts, "_g")
    member = F.size(F.filter("_cuts", lambda c: F.col("_rank") > c))
    return ranked.withColumn(out, member).select(*[quoted(c) for c in df.columns], out)


def membership(
    df: DataFrame,
    out: str,
    plan: Callable[[dict[str, int]], dict[str, list[int]]],
    key: Sequence[str] = (),
    seed: int = 42,
    group: str | None = None,
    order_by: Sequence[str] = (),
    table: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``out``: the number of planned cuts before each row, in key order.

    Rows are ordered by the hash of ``key`` and ``seed``, or by ``order_by`` when given. ``table`` is the plan as a table, (_g, n) to (_g, _cuts), for
    many groups.
    """
    key = list(key) or list(df.columns)
    if order_by:
        order, width = sortable_key(df, order_by)
    else:
        order, width = row_hash(key, seed), 32
    if group is not None and table is not None and not order_by:
        if df.agg(F.approx_count_distinct(_group_code(group))).first()[0] > MANY_GROUPS:
            return _ranked(df, out, order, group, table)
    cuts = locate_cuts(df, order, width, plan, group)
    if any(c.splits_ties for cs in cuts.values() for c in cs):
        order = F.concat(order, row_hash(sorted(df.columns)))
        width += 32
        cuts = locate_cuts(df, order, width, plan, group)

    base = df.withColumn("_o", order)
    if group is None:
        tagged = base.withColumn(out, _passed(F.col("_o"), cuts.get(ALL_ROWS, [])))
    elif sum(len(c) for c in cuts.values()) <= 200:
        member = F.lit(None).cast("int")
        for g, group_cuts in cuts.items():
            member = F.when(_group_code(group) == F.lit(g), _passed(F.col("_o"), group_cuts)).otherwise(member)
        tagged = base.withColumn(out, member)
    else:
        # one row per group that the driver has already counted
        table = df.sparkSession.createDataFrame(
            [(g, [c.key for c in cs]) for g, cs in cuts.items()], "_g string, _cuts array<string>"
        )
        tagged = (
            base.withColumn("_g", _group_code(group))
            .join(table, "_g")
            .withColumn(out, F.size(F.filter("_cuts", lambda c: F.col("_o") > c)))
        )
    keep = [quoted(c) for c in df.columns] + [out]
    split_keys = [
        (_group_code(group) == F.lit(g)) & (F.col("_o") == F.lit(c.key))
        for g, cs in cuts.items()
        for c in cs
        if c.splits_ties
    ]
    if not split_keys:
        return tagged.select(*keep)
    tied = split_keys[0]
    for condition in split_keys[1:]:
        tied = tied | condition
    equal_rows = base.where(tied).select(*keep[:-1])
    expanded = _expand_equal_rows(equal_rows, order, cuts, group, out)
    return tagged.where(~tied).select(*keep).unionByName(expanded)
