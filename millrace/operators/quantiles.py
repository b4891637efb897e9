"""Exact interpolated quantiles that never hold a whole column in one place.

Columns with few distinct values are reduced to (value, count) first. For the others a
sketch gives a narrow bracket around the wanted ranks, one pass counts the rows below
and inside it, and the bracket is narrowed until few distinct values are left in it. Where sketches stop helping, the bracket's range of
values is halved pass by pass, so it always ends, and no task ever gets more than ``DISTINCT_LIMIT`` values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import number

DISTINCT_LIMIT = 200_000
SKETCH_ACCURACY = 2_000
SKETCH_ROUNDS = 4  # brackets that a sketch did not settle by then are halved


@dataclass
class _Target:
    """One column and probability: its two order statistics lie in [low, high]."""

    column: str
    prob: float
    n: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0
    distinct: int = 0
    slack: float = 1.5
    rounds: int = 0
    pair: tuple[float, float] | None = None  # the two values themselves

    def __post_init__(self) -> None:
        self.inside = self.n

    @property
    def position(self) -> float:
        return (self.n - 1) * self.prob

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    def within(self, value: Column) -> Column:
        ok = value.isNotNull()
        if self.low is not None:
            ok = ok & (value >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (value <= F.lit(self.high))
        return ok


def _narrow(values: DataFrame, targets: list[_Target]) -> None:
    """One round: a sketch inside each bracket, then a counting pass that proves it."""
    sketches: dict[tuple, list[float]] = {}
    place: list[tuple[tuple, int]] = []
    for t in targets:
        step = t.slack / SKETCH_ACCURACY
        first, last = (r - t.below for r in t.ranks)
        span = max(t.inside - 1, 1)
        probes = sketches.setdefault((t.column, t.low, t.high), [])
        place.append(((t.column, t.low, t.high), len(probes)))
        probes += [max(first / span - step, 0.0), min(last / span + step, 1.0)]
    aggs = []
    for i, ((a, low, high), probes) in enumerate(sketches.items()):
        inside = F.when(_Target(a, 0.0, 1, low, high).within(F.col(a)), F.col(a))
        aggs.append(F.percentile_approx(inside, probes, SKETCH_ACCURACY).alias(f"b{i}"))
    row = values.agg(*aggs).first()
    found = dict(zip(sketches, row))
    bounds = [found[key][at : at + 2] for key, at in place]
    checks = []
    for i, t in enumerate(targets):
        x = F.col(t.column)
        lo, hi = F.lit(bounds[i][0]), F.lit(bounds[i][1])
        inside = (x >= lo) & (x <= hi)
        checks += [
            F.count_if(x < lo).alias(f"below{i}"),
            F.count_if(inside).alias(f"inside{i}"),
            F.approx_count_distinct(F.when(inside, x)).alias(f"distinct{i}"),
        ]
    seen = values.agg(*checks).first()
    for i, t in enumerate(targets):
        below, inside = seen[f"below{i}"], seen[f"inside{i}"]
        first, last = t.ranks
        if below <= first and last < below + inside and inside < t.inside:
            t.low, t.high = bounds[i]
            t.below, t.inside, t.distinct = below, inside, 1 if t.low == t.high else seen[f"distinct{i}"]
        elif below <= first and last < below + inside:
            # the bracket did not shrink: few distinct values carry it, or the probes were too wide
            t.distinct, t.slack = seen[f"distinct{i}"], t.slack / 4
        else:
            t.slack *= 4
        t.rounds += 1


def _halve(values: DataFrame, targets: list[_Target]) -> None:
    """One round by value: keep the half of each bracket that holds its ranks; if they lie on both sides, their two values are known."""
    bare = [t for t in targets if t.low is None or t.high is None]
    if bare:
        ends = values.agg(*[f(t.column).alias(f"{n}{i}") for i, t in enumerate(bare) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for i, t in enumerate(bare):
            t.low, t.high = ends[f"lo{i}"], ends[f"hi{i}"]
    aggs, middles = [], []
    for i, t in enumerate(targets):
        x, middle = F.col(t.column), t.low / 2 + t.high / 2
        middles.append(middle)
        left, right = t.within(x) & (x <= F.lit(middle)), t.within(x) & (x > F.lit(middle))
        aggs += [F.count_if(left).alias(f"n{i}"), F.max(F.when(left, x)).alias(f"l{i}"), F.min(F.when(right, x)).alias(f"r{i}"),
                 F.approx_count_distinct(F.when(left, x)).alias(f"dl{i}"), F.approx_count_distinct(F.when(right, x)).alias(f"dr{i}")]
    seen = values.agg(*aggs).first()
    for i, t in enumerate(targets):
        n, (first, last) = seen[f"n{i}"], t.ranks
        if last < t.below + n:
            t.high, t.inside, t.distinct = seen[f"l{i}"], n, seen[f"dl{i}"]
        elif first >= t.below + n:
            t.low, t.below, t.inside, t.distinct = seen[f"r{i}"], t.below + n, t.inside - n, seen[f"dr{i}"]
        else:
            t.pair, t.distinct = (seen[f"l{i}"], seen[f"r{i}"]), 0
        if t.low == t.high:
            t.distinct = 1


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    distinct_limit: int = DISTINCT_LIMIT,
    known: Mapping[str, tuple[int, int]] | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, nulls and NaN skipped.

    ``known`` gives the non-null rows and the estimated distinct values per column where
    the caller already has them from another pass.
    """
    if not columns:
        return {}
    alias = {c: f"c{i}" for i, c in enumerate(columns)}
    values = df.select(*[number(df, c).alias(alias[c]) for c in columns])
    if known is None:
        row = values.agg(
            *[F.count(a).alias(f"n_{a}") for a in alias.values()],
            *[F.approx_count_distinct(a).alias(f"d_{a}") for a in alias.values()],
        ).first()
        known = {c: (row[f"n_{a}"], row[f"d_{a}"]) for c, a in alias.items()}
    targets = [_Target(a, p, known[c][0], distinct=min(known[c])) for c, a in alias.items() for p in probs if known[c][0]]
    while wide := [t for t in targets if t.distinct > distinct_limit]:
        for narrow, some in ((_narrow, [t for t in wide if t.rounds < SKETCH_ROUNDS]), (_halve, [t for t in wide if t.rounds >= SKETCH_ROUNDS])):
            if some:
                narrow(values, some)
    found = _order_statistics(values, targets)
    out: dict[str, list[float | None]] = {}
    for c, a in alias.items():
        out[c] = []
        for p in probs:
            target = next((t for t in targets if t.column == a and t.prob == p), None)
            if target is None:
                out[c].append(None)
                continue
            first, last = target.ranks
            lo, hi = found[a, first], found[a, last]
            out[c].append(lo + (hi - lo) * (target.position - first))
    return out


def _order_statistics(values: DataFrame, targets: list[_Target]) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks, from (value, count) tables of the open brackets."""
    # a bracket of one value needs no further look
    out = {(t.column, r): t.low for t in targets if t.low is not None and t.low == t.high for r in t.ranks}
    for t in targets:
        if t.pair is not None:
            out.update(zip([(t.column, r) for r in t.ranks], t.pair))
    targets = [t for t in targets if t.pair is None and (t.low is None or t.low != t.high)]
    if not targets:
        return out
    ranks: dict[tuple, set[int]] = {}
    for t in targets:
        ranks.setdefault((t.column, t.low, t.high, t.below), set()).update(t.ranks)
    brackets = list(ranks)
    entries = []
    for a, low, high, _ in brackets:
        within = _Target(a, 0.0, 1, low, high).within(F.col(a))
        entries.append(F.col(a) if low is None else F.when(within, F.col(a)))
    counted = (
        values.select(F.posexplode(F.array(*entries)).alias("bracket", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # at most DISTINCT_LIMIT rows per bracket; the other side has one row per bracket
    wanted = values.sparkSession.createDataFrame(
        [(i, sorted(r - b[3] for r in ranks[b])) for i, b in enumerate(brackets)], "bracket int, ranks array<bigint>"
    )
    running = Window.partitionBy("bracket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hits = F.filter("ranks", lambda r: (F.col("upto") > r) & (F.col("upto") - F.col("n") <= r))
    rows = (
        counted.withColumn("upto", F.sum("n").over(running))
        .join(F.broadcast(wanted), "bracket")
        .select("bracket", "value", F.explode(hits).alias("rank"))
        .collect()
    )
    for row in rows:
        a, _, _, below = brackets[row["bracket"]]
        out[a, row["rank"] + below] = row["value"]
    return out


# --- leaving out one fold at a time ------------------------------------------------------------


def _fold_brackets(values: DataFrame, columns: Sequence[str], prob: float, counts: Mapping[str, Mapping[int, int]]) -> dict[str, tuple[float, float, dict[int, int]] | None]:
    """For each column a bracket that holds the wanted ranks of every "all folds but f" and few distinct values, with the rows below it by fold; None where none was found."""
    out: dict[str, tuple[float, float, dict[int, int]] | None] = {}
    left, slack = list(columns), 8.0 / SKETCH_ACCURACY
    for _ in range(SKETCH_ROUNDS):
        if not left:
            break
        row = values.agg(*[F.percentile_approx(c, [max(prob - slack, 0.0), min(prob + slack, 1.0)], SKETCH_ACCURACY) for c in left]).first()
        bounds = dict(zip(left, row))
        checks = []
        for i, c in enumerate(left):
            x, lo, hi = F.col(c), F.lit(bounds[c][0]), F.lit(bounds[c][1])
            checks += [F.count_if(x < lo).alias(f"below{i}"), F.count_if((x >= lo) & (x <= hi)).alias(f"inside{i}"),
                       F.approx_count_distinct(F.when((x >= lo) & (x <= hi), x)).alias(f"distinct{i}")]
        rows = values.groupBy("fold").agg(*checks).collect()
        still = []
        for i, c in enumerate(left):
            below, inside = ({r["fold"]: r[f"{k}{i}"] for r in rows} for k in ("below", "inside"))
            ok = all(_ranks_inside(counts[c], below, inside, prob, f) for f in counts[c])
            if ok and sum(r[f"distinct{i}"] for r in rows) <= 2 * DISTINCT_LIMIT:
                out[c] = (*bounds[c], below)
            elif not ok:
                still.append(c)
        left, slack = still, slack * 4
    return {c: out.get(c) for c in columns}


def _others(by_fold: Mapping[int, int], fold: int) -> int:
    return sum(n for f, n in by_fold.items() if f != fold)


def _ranks_inside(n: Mapping[int, int], below: Mapping[int, int], inside: Mapping[int, int], prob: float, fold: int) -> bool:
    rest = _others(n, fold)
    first, last = _Target("", prob, rest).ranks
    return rest == 0 or (_others(below, fold) <= first and last < _others(below, fold) + _others(inside, fold))


def quantiles_without_fold(
    df: DataFrame, columns: Sequence[str], prob: float, counts: Mapping[str, Mapping[int, int]], distinct: Mapping[str, int]
) -> dict[tuple[int, str], float | None]:
    """The interpolated quantile of every column over "all folds but f", for every f.

    ``df`` has a column fold; ``counts`` are the non-null rows of each column by fold, ``distinct`` estimates of its distinct values. Values are counted once for all
    folds, as (column, value, fold), and only inside a bracket that serves them all; what belongs to "all but f" follows by subtraction.
    """
    alias = {c: f"c{i}" for i, c in enumerate(columns)}
    values = df.select("fold", *[number(df, c).alias(a) for c, a in alias.items()])
    wide = [c for c in columns if distinct[c] > DISTINCT_LIMIT]
    brackets = _fold_brackets(values, [alias[c] for c in wide], prob, {alias[c]: counts[c] for c in wide}) if wide else {}
    out: dict[tuple[int, str], float | None] = {}
    folds = sorted({f for by_fold in counts.values() for f in by_fold})
    for c in wide:
        if brackets[alias[c]] is None:  # no bracket of few values serves all folds: a search for each
            copies = df.select(*[F.when(F.col("fold") != f, number(df, c)).alias(str(f)) for f in folds])
            found = exact_quantiles(copies, [str(f) for f in folds], [prob], known={str(f): (_others(counts[c], f), distinct[c]) for f in folds})
            out.update({(f, c): found[str(f)][0] for f in folds})
    shared = [c for c in columns if (folds[0] if folds else None, c) not in out]
    entries, below = [], {}
    for c in shared:
        low, high, under = brackets.get(alias[c]) or (None, None, {})
        x = F.col(alias[c])
        below[c] = under
        entries.append(x if low is None else F.when((x >= F.lit(low)) & (x <= F.lit(high)), x))
    if not shared:
        return out
    counted = (
        values.select("fold", F.posexplode(F.array(*entries)).alias("place", "value")).where(F.col("value").isNotNull())
        .groupBy("place", "value").agg(*[F.count_if(F.col("fold") == f).alias(f"n{f}") for f in folds])
    )
    # a few times DISTINCT_LIMIT rows a column at most
    running = Window.partitionBy("place").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    total = counted.select("place", "value", *[f"n{f}" for f in folds], *[F.sum(f"n{f}").over(running).alias(f"u{f}") for f in folds])
    wanted, hits = [], []
    for i, c in enumerate(shared):
        for f in folds:
            rest = _others(counts[c], f)
            out[f, c] = None
            if rest:
                for rank in set(_Target(c, prob, rest).ranks):
                    wanted.append((c, f, rank))
                    own = F.lit(0)
                    upto = F.lit(_others(below[c], f))
                    for g in folds:
                        if g != f:
                            own, upto = own + F.col(f"n{g}"), upto + F.col(f"u{g}")
                    hits.append(F.when((F.col("place") == i) & (upto > rank) & (upto - own <= rank), F.struct(F.lit(len(wanted) - 1).alias("k"), F.col("value"))))
    rows = total.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h")).select("h.k", "h.value").collect() if hits else []
    found = {wanted[r["k"]]: r["value"] for r in rows}
    for c in shared:
        for f in folds:
            if rest := _others(counts[c], f):
                t = _Target(c, prob, rest)
                lo, hi = (found[c, f, r] for r in t.ranks)
                out[f, c] = lo + (hi - lo) * (t.position - t.ranks[0])
    return out
