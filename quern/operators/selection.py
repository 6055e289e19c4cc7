"""Greedy, coverage-balanced selection: sequential by nature, in one group or in two rounds.

What a step samples doesn't depend on what was picked before, so the places that any step looks at are
known from the number of candidates. Only rows at those places reach the task that picks: at most
picks times (sample size + 1), however many candidates there are, and with the picks that all of them would give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.config import Curation
from quern.session import materialize

FIELDS = "doc_id long, pos int, category string, prosody string, n_accent int, bigrams array<string>"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_IN_TASK = (1 << 33) - 1
Derive = Callable[[DataFrame], DataFrame]


def draws(n: int, size: int, seed: int, c: Curation) -> Iterator[np.ndarray]:
    """Of every step the sampled places among the rows that are left, of ``n`` at first."""
    rng = np.random.default_rng(seed)
    for left in range(n, max(0, n - size), -1):
        yield rng.choice(left, min(c.sample_size, left), replace=False)


def looked_at(n: int, size: int, seed: int, c: Curation) -> np.ndarray:
    """Places, sorted, whose rows any step may look at: those drawn, and the last ones, which fill the places of picks."""
    return np.unique(np.concatenate([np.arange(max(0, n - size), n), *draws(n, size, seed, c)]))


def _greedy(rows: pa.Table, places: np.ndarray, n: int, size: int, seed: int, c: Curation) -> list[int]:
    """Row numbers of the picks, in order, for rows in the order of their places among ``n``."""
    lists = rows.column("bigrams").combine_chunks()
    values = pc.dictionary_encode(lists.flatten())
    code = values.indices.to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    worth, covered = np.ones(len(values.dictionary)), np.zeros(len(values.dictionary), np.int64)
    accents = rows.column("n_accent").to_numpy().astype(np.float64)
    over = []  # for each kind of class: class of every row, its target, its number of picks
    for column, target in (("category", c.length_target), ("prosody", c.prosody_target)):
        classes, names = pd.factorize(rows.column(column).to_pandas(), use_na_sentinel=False)
        over.append((classes, np.array([target.get(x, 0) for x in names], np.float64), np.zeros(len(names))))
    left, picked = np.arange(rows.num_rows), []
    for step, drawn in enumerate(draws(n, size, seed, c)):
        at = np.searchsorted(places, drawn)
        i, whole = left[at], step or 1
        which = np.repeat(np.arange(len(i)), lengths[i])
        inner = np.arange(len(which)) - np.repeat(np.cumsum(lengths[i]) - lengths[i], lengths[i])
        value = np.bincount(which, worth[code[starts[i][which] + inner]], len(i)) + c.accent_weight * accents[i]
        for classes, target, mine in over:
            value -= c.balance_weight * np.maximum(0.0, mine / whole - target)[classes[i]]
        # equal scores, whatever the order of their sums: the first that was drawn
        best = at[np.argmax(np.where(lengths[i] > 0, np.round(value, 9), -1e9))]
        pick = left[best]
        picked.append(int(pick))
        left[best] = left[np.searchsorted(places, n - step - 1)]
        own = code[starts[pick] : starts[pick] + lengths[pick]]
        np.add.at(covered, own, 1)
        worth[own] = 1 / (1 + covered[own])
        for classes, _, mine in over:
            mine[classes[pick]] += 1
    return picked


def _sorted(rows: pa.Table) -> pa.Table:
    """By id and position, nulls last; then by the rest, so that the order is the same however the rows came."""
    rows = rows.append_column("joined", pc.binary_join(rows.column("bigrams"), "\0"))
    return rows.sort_by([(x, "ascending") for x in ("doc_id", "pos", "category", "prosody", "n_accent", "joined")]).select(NAMES)


def greedy(pdf: pd.DataFrame, size: int, seed: int, c: Curation) -> list[int]:
    """Row numbers of the picks, in order.

    Each step scores a random sample of what is left and takes the best: rare bigrams first, more
    accent markers, and less of classes that are over their target.
    """
    order = pdf.sort_values(["doc_id", "pos"]).index.to_numpy()
    rows = pa.table({"bigrams": pa.array(pdf["bigrams"].loc[order].map(list), pa.list_(pa.string()))} | {x: pa.array(pdf[x].loc[order], from_pandas=True) for x in ("category", "prosody", "n_accent")})
    return [int(order[i]) for i in _greedy(rows, np.arange(len(pdf)), len(pdf), size, seed, c)]


def _first_round(rows: DataFrame, share: int, groups: int, seed: int, c: Curation, derive: Derive) -> DataFrame:
    """The picks of each of ``groups`` hash parts of the rows.

    The rows are sorted over all tasks, numbered and written once; those at the places that are looked at go on.
    """
    order = ["part", F.asc_nulls_last("doc_id"), F.asc_nulls_last("pos")]
    rest = [x for x in rows.columns if x not in ("doc_id", "pos")]
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(groups)).cast("int"))
    ranged = parted.repartitionByRange(tasks, *order).sortWithinPartitions(*order, *rest)
    numbered = materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "greedy_order")
    totals: dict[int, int] = {}
    before: dict[int, int] = {}  # rows of the same task in earlier parts
    base: dict[tuple[int, int], int] = {}  # from the number in a task to the place in the part
    for task, part, n in sorted(tuple(r) for r in numbered.groupBy(F.shiftright("place", 33), "part").count().collect()):
        base[task, part] = totals.get(part, 0) - before.get(task, 0)
        totals[part] = totals.get(part, 0) + n
        before[task] = before.get(task, 0) + n

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, np.ndarray] = {}
        for batch in batches:
            number, part = batch.column("place").to_numpy(), batch.column("part").to_numpy()
            task, place, keep = number >> 33, number & _IN_TASK, np.zeros(len(number), bool)
            for t, p in set(zip(task.tolist(), part.tolist(), strict=True)):
                if p not in wanted:
                    wanted[p] = looked_at(totals[p], share, seed, c)
                mine = np.flatnonzero((task == t) & (part == p))
                place[mine] += base[t, p]
                keep[mine] = wanted[p][np.minimum(np.searchsorted(wanted[p], place[mine]), len(wanted[p]) - 1)] == place[mine]
            yield batch.set_column(batch.schema.get_field_index("place"), "place", pa.array(place)).filter(pa.array(keep))

    def pick(found: pa.Table) -> pa.Table:
        found = found.sort_by("place")
        return found.select(NAMES).take(pa.array(_greedy(found, found.column("place").to_numpy(), totals[found.column("part")[0].as_py()], share, seed, c)))

    found = derive(numbered.mapInArrow(looked, numbered.schema))
    return found.select(*NAMES, "part", "place").groupBy("part").applyInArrow(pick, FIELDS)


def greedy_distributed(rows: DataFrame, size: int, groups: int, seed: int = 1, c: Curation = Curation(), spare: float = 2.0, derive: Derive | None = None) -> DataFrame:
    """Two rounds: every group picks its share times ``spare``, then the picks are picked from.

    The first round is parallel and each of its groups is a hash part of the rows, so ``groups``
    bounds what a task holds; the second holds ``spare * size`` rows. No approximation guarantee is
    claimed, as the balance terms aren't submodular.

    derive: adds those of the columns ``NAMES`` that the rows lack, but for id and position; it sees the rows that are looked at only.
    """
    share = int(np.ceil(spare * size / groups))
    first = _first_round(rows if derive else rows.select(*NAMES), share, groups, seed, c, derive or (lambda found: found))
    if groups == 1 and spare == 1.0:
        return first

    def pick(found: pa.Table) -> pa.Table:
        found = _sorted(found)
        return found.take(pa.array(_greedy(found, np.arange(found.num_rows), found.num_rows, size, seed, c)))

    return first.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(pick, FIELDS)


def greedy_exact(rows: DataFrame, size: int, seed: int = 1, c: Curation = Curation(), derive: Derive | None = None) -> DataFrame:
    """The sequential algorithm over all rows: one task holds those that its samples look at."""
    return greedy_distributed(rows, size, 1, seed, c, 1.0, derive)
