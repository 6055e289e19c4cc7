"""Substring deduplication: fuzzy passages that repeat across documents, found by collinear chaining.

1. Seeds. Of every window of ``WINDOW`` consecutive k-word sequences the one with the least hash is
   a seed, so equal stretches of ``K + WINDOW - 1`` words have equal seeds whatever surrounds them.
   ``count_exchange`` tells of each seed whether several documents hold it, and the first that does, in
   the order of ids. Its requests carry one row of numbers per bucket and seed, so a seed that a third
   of all documents hold is as cheap as any, and none is treated in another way for being frequent.
2. Matches. Each occurrence is joined to the first holder of its seed. So matches grow with
   occurrences and not with their square, and only a passage's first document keeps it.
3. Chains. A document's matches with one source are chained: both places increase, a seed earns its
   words, and words that are skipped on either side cost. A Fenwick tree over source places, which
   matches leave when they are out of reach, gives the best predecessor of each match among all within
   ``MOST_GAP`` words on both sides; so passages far apart don't hide each other. Chains of two seeds or more go on.
4. Exact windows. So that earlier holders of parts can't hide the one that holds the whole, every window of
   ``min_words`` words is also looked up by its hash: a block of the key space tells the first document
   that holds it. Only windows all of whose seeds occur in several documents are asked for, once per
   bucket; runs of found windows are chains too. So a word of a window that an earlier document holds
   word for word is always cut, repeats within either document included.
5. Alignment. The source's words around each chain are fetched, the chain is aligned word by word
   (equal words between its seeds, edits in the gaps, and an extension at both ends that stops where
   edits outweigh matches), and kept if it has ``min_words`` words of which ``identity`` agree. So a
   passage is found if two of its seeds are intact, whatever share of it they span.
6. All holders. Two different seeds within reach that earlier documents hold, one of them not wholly cut by
   then, ask for all their holders. Texts with the same pairs are compared in blocks of bounded size; those that
   bounds on equal words leave are chained and aligned as above. So first holders can't hide another. A pair
   that a holder repeats is compared where it has it first; a document that an earlier one holds as a whole is left to that.

Fuzziness. ``identity`` bounds what is accepted. A passage with edits has two intact seeds with a chance
that falls with the rate of edits; README has the recall at several rates.

The texts are dealt to buckets once; the exchange of that is used again by all steps.

``search`` (``find``: without step 6) returns the rows with ``cleaned``, the text without its passages that an earlier document
holds, and ``passages``. Results in odd cases: null text stays null and gives no passages; rows with
a null id are left alone; rows that repeat an id are one document, whose texts aren't compared with
each other; a passage that repeats within one document only is left; an empty table gives no rows.
Columns named ``cleaned`` or ``passages`` are replaced, others kept. Words are compared with A-Z
lowered.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from operator import lt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import count_exchange as exchange
from quern.llm import wordhash
from quern.llm.aside import set_aside

K = 6
WINDOW = 8
#: Seeds of a chain that is aligned, at least.
LEAST_SEEDS = 2
#: A chain isn't continued over more words than this on either side.
MOST_GAP = 60
GAP_COST = 0.05
#: Words around a chain that an alignment may extend to.
MARGIN = 100
#: Bytes of the words of a group of texts in one block of its comparison, about.
BLOCK_BYTES = 2_000_000
#: Of a part of a bucket: its first row, words, their rows, where rows start, places and keys of seeds, the seed of each window.
Part = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_PIECE = 1 << 14
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _least(h: np.ndarray) -> np.ndarray:
    """The place of the least, the first of equal ones, of each ``WINDOW`` consecutive values."""
    value, at, width = h, np.arange(len(h)), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        later = value[step:] < value[:-step]
        value, at, width = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step]), width + step
    return at


def seeds(words: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``words``) of the sampled k-word sequences, and their keys."""
    return _sampled(words, owners)[:2]


def _sampled(words: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``seeds``, and the place of the seed of each window, -1 where it isn't within one text."""
    n = len(words) - K + 1
    of_window = np.empty(0, np.int64)
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64), of_window
    h = np.empty(n, np.uint64)
    for a in range(0, n, _PIECE):  # pieces that stay in a core's cache
        b = min(n, a + _PIECE)
        x = np.full(b - a, K, np.uint64)
        for k in range(K):
            x *= np.uint64(0xD6E8FEB86659FD93)
            x += words[a + k : b + k]
            x = wordhash.mix(x)
        h[a:b] = x
    inside = owners[:n] == owners[K - 1 :]
    if n >= WINDOW:
        least = np.concatenate([a + _least(h[a : a + _PIECE + WINDOW - 1]) for a in range(0, n - WINDOW + 1, _PIECE)])
        whole = inside[: n - WINDOW + 1] & (owners[: n - WINDOW + 1] == owners[WINDOW + K - 2 :])
        chosen = np.zeros(n, bool)
        chosen[least[whole]] = True
        of_window = np.where(whole, least, -1)
    else:
        chosen = np.zeros(n, bool)
    # documents with fewer sequences than a window: the least of them
    first = np.flatnonzero(inside & np.concatenate(([True], owners[1:n] != owners[: n - 1])))
    for f in first.tolist():
        stop = f + int(np.searchsorted(owners[f : f + WINDOW + K], owners[f], "right")) - K + 1
        if 0 < stop - f < WINDOW:
            chosen[f + int(h[f:stop].argmin())] = True
    at = np.flatnonzero(chosen)
    return at, h[at], of_window


def _hashed(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a bucket, part by part: the number of the part's first row, the words, their rows in the part, and where each row's words start."""
    base = 0
    for part in exchange.slices(table):
        words, owners = wordhash.word_hashes(exchange.texts_of(part))
        yield base, words, owners, np.searchsorted(owners, np.arange(part.num_rows))
        base += part.num_rows


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have an id, and those."""
    docs = table.column("key")
    return docs.is_valid().to_numpy(), docs.fill_null(0).to_numpy()


def _first_in_bucket(table: pa.Table, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and for ``exchange.first_holder`` the first document in the bucket that holds each."""
    key, doc, place = (np.concatenate([x[j] for x in found]) if found else np.empty(0, np.int64) for j in range(3))
    order = np.lexsort((place, doc, key))
    key, doc, place = key[order].astype(np.uint64), doc[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    last = np.concatenate((first[1:], [len(key)])) - 1 if len(first) else first
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    return key[first], np.stack((doc[first], place[first] * 2 + (doc[last] != doc[first]), np.full(len(first), bucket)))


def _asked_seeds(table: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    known, ids = _ids(table)
    found = []
    for base, words, owners, start in _hashed(table):
        at, key = seeds(words, owners)
        key = wordhash.keys(key, bits)
        row = owners[at]
        with_id = known[row + base]
        found.append((key[with_id], ids[row + base][with_id], (at - start[row])[with_id]))
    return _first_in_bucket(table, found)


def _chained(parts: list[Part], known: np.ndarray, ids: np.ndarray, found: list[np.ndarray], distinct: np.ndarray, first: np.ndarray) -> list[tuple]:
    """From a bucket and the first holders of its distinct seeds to the chains of each document with each of those."""
    rows: list[tuple] = []
    for (base, _, owners, start, at, key, _), where in zip(parts, found, strict=True) if len(distinct) else ():
        row = owners[at]
        # a seed of rows without id only was not asked for
        source, flagged, bucket = first[:, where]
        hit = np.flatnonzero((distinct[where] == key) & (flagged & 1 > 0) & known[row + base] & (source < ids[row + base]))
        row, place, source, other, bucket = row[hit], (at - start[row])[hit], source[hit], flagged[hit] >> 1, bucket[hit]
        order = np.lexsort((other, place, source, row))
        row, place, source, other, bucket = (x[order] for x in (row, place, source, other, bucket))
        edges = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (source[1:] != source[:-1]), [True]))) if len(row) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a < LEAST_SEEDS:
                continue
            for one in chain(place[a:b].tolist(), other[a:b].tolist()):
                if len(one) >= LEAST_SEEDS:
                    rows.append((int(ids[row[a] + base]), int(bucket[a]), int(source[a]), np.stack((place[a:b][one], other[a:b][one]), axis=1).astype(np.int32).tobytes()))
    return rows


def _shared(table: pa.Table, parts: list[Part], known: np.ndarray, ids: np.ndarray, found: list[np.ndarray], distinct: np.ndarray, first: np.ndarray, whole: set[int]) -> list[tuple]:
    """Of each text the seeds that several documents hold, if two are within reach; but for texts that an earlier document holds as a whole.

    Places are doubled, and one more where an earlier document holds the seed; differences travel.
    """
    rows: dict[tuple[int, int], tuple] = {}
    marks, bucket = table.column("mark"), table.column("bucket")[0].as_py() if table.num_rows else 0
    for (base, _, owners, start, at, key, _), where in zip(parts, found, strict=True) if len(distinct) else ():
        hit = np.flatnonzero((distinct[where] == key) & (first[1][where] & 1 > 0) & known[owners[at] + base])
        row, place, key, source = owners[at[hit]], at[hit] - start[owners[at[hit]]], key[hit], first[0][where[hit]]
        edges = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True]))) if len(row) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i = int(row[a]) + base
            if b - a >= LEAST_SEEDS and i not in whole and (np.diff(place[a:b]) <= MOST_GAP + K).any():
                doc, mark = int(ids[i]), marks[i].as_py()
                rows[doc, mark] = doc, bucket, None, exchange.packed(np.diff(place[a:b] * 2 + (source[a:b] < doc), prepend=0).astype(np.int32)), mark, exchange.packed(key[a:b])
    return list(rows.values())


def _chain_rows(table: pa.Table, rows: list[tuple], exact: bool | None) -> pa.Table:
    """Rows of chains; with exact null, of the seeds that ``_shared`` tells."""
    mine = table.column("bucket")[0].as_py() if table.num_rows else 0
    return pa.table(
        {
            "bucket": pa.array([mine] * len(rows), pa.int32()),
            "doc": pa.array([r[0] for r in rows], pa.int64()),
            "source_bucket": pa.array([r[1] for r in rows], pa.int32()),
            "source": pa.array([r[2] for r in rows], pa.int64()),
            "anchors": pa.array([r[3] for r in rows], pa.binary()),
            "exact": pa.array([exact] * len(rows), pa.bool_()),
            "mark": pa.array([r[4] if exact is None else None for r in rows], pa.int64()),
            "held": pa.array([r[5] if exact is None else None for r in rows], pa.binary()),
        }
    )


def _window_keys(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the sequences of so many words at the given places."""
    up, down = wordhash.power_table(len(words) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))
    return wordhash.mix((total[at + size] - total[at]) * down[at])


def _windows_of(words: np.ndarray, owners: np.ndarray, size: int) -> np.ndarray:
    """Places of the sequences of so many words that lie within one text."""
    n = len(words) - size + 1
    return np.flatnonzero(owners[:n] == owners[size - 1 :]) if n > 0 else np.empty(0, np.int64)


def _sampled_parts(table: pa.Table, bits: int) -> list[Part]:
    """``_hashed``, with each part's seeds, their keys, and the seed of each window."""
    parts = []
    for base, words, owners, start in _hashed(table):
        at, key, of_window = _sampled(words, owners)
        parts.append((base, words, owners, start, at, wordhash.keys(key, bits), of_window))
    return parts


def _distinct_seeds(parts: list[Part], known: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct seeds of rows with an id, and part by part each seed's place among them; that of another, if it isn't one."""
    distinct = exchange.summed(np.concatenate([key[known[owners[at] + base]] for base, _, owners, _, at, key, _ in parts]))[0] if parts else np.empty(0, np.uint64)
    return distinct, [np.minimum(np.searchsorted(distinct, key), max(0, len(distinct) - 1)) for *_, key, _ in parts]


def _held_windows(parts: list[Part], known: np.ndarray, found: list[np.ndarray], distinct: np.ndarray, first: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Part by part the windows that others may hold too, those without a seed of its own: places and keys.

    That depends on a window's words alone, so windows that are equal are all here or none.
    """
    several = first[1] & 1 if len(distinct) else np.zeros(1, np.int64)
    windows = []
    for (base, words, owners, _, at, _, of_window), where in zip(parts, found, strict=True):
        alone = np.zeros(len(words) + 1, bool)
        alone[at[several[where] == 0]] = True
        places = _windows_of(words, owners, size)
        inner = size - (K + WINDOW - 1) + 1
        if inner > 0 and len(places):
            bad = np.concatenate(([0], np.cumsum(alone[of_window])))  # -1 is the last, never alone
            places = places[bad[places + inner] == bad[places]]
        places = places[known[owners[places] + base]]
        windows.append((places, _window_keys(words, size, places)))
    return windows


def _asked_windows(size: int, bits: int) -> Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray]]:
    """From a bucket and the first holders of its seeds to the windows that others may hold too."""

    def run(table: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        known, ids = _ids(table)
        parts = _sampled_parts(table, bits)
        distinct, found = _distinct_seeds(parts, known)
        windows = _held_windows(parts, known, found, distinct, exchange.received(answers, len(distinct)), size)
        return _first_in_bucket(table, [(key, ids[owners[at] + base], at - start[owners[at]]) for (base, _, owners, start, *_), (at, key) in zip(parts, windows, strict=True)])

    return run


def _chains(size: int, bits: int, shared: bool = False) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From a bucket and the first holders of its seeds and windows to its chains: those of seeds, and those that cover every window which an earlier document holds.

    shared: with the rows of ``_shared``.
    """

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        known, ids = _ids(table)
        parts = _sampled_parts(table, bits)
        distinct, where_in = _distinct_seeds(parts, known)
        first = exchange.received(answers.filter(answers.column("seeds")), len(distinct))
        fuzzy = _chained(parts, known, ids, where_in, distinct, first)
        windows = _held_windows(parts, known, where_in, distinct, first, size)
        keys = exchange.summed(np.concatenate([key for _, key in windows]))[0] if windows else np.empty(0, np.uint64)
        found: list[tuple] = []
        whole: set[int] = set()
        of_seeds = first
        if len(keys):
            first = exchange.received(answers.filter(pc.invert(answers.column("seeds"))), len(keys))
            for (base, _, owners, start, *_), (at, key) in zip(parts, windows, strict=True):
                where = np.searchsorted(keys, key)
                doc = ids[owners[at] + base]
                hit = (first[1][where] & 1 > 0) & (first[0][where] < doc)
                at, doc, (source, flagged, bucket) = at[hit], doc[hit], first[:, where[hit]]
                place = flagged >> 1
                row = owners[at]
                own = at - start[row]
                if len(at):
                    new = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1]) | (place[1:] != place[:-1] + 1)))
                    a = np.flatnonzero(new)
                    b = np.concatenate((a[1:], [len(at)])) - 1
                    runs = list(zip(row[a].tolist(), own[a].tolist(), (own[b] + size).tolist(), doc[a].tolist(), source[a].tolist(), place[a].tolist(), bucket[a].tolist(), strict=True))
                    # of runs that overlap, no more than cover the same words
                    taken: list[tuple] = []
                    for x in runs:
                        while len(taken) > 1 and taken[-2][0] == x[0] and x[1] <= taken[-2][2]:
                            taken.pop()
                        taken.append(x)
                    found += taken
                    size_of = np.bincount(owners)
                    whole.update(x[0] + base for x in taken if x[1] == 0 and x[2] == size_of[x[0]])
        held = _shared(table, parts, known, ids, where_in, distinct, of_seeds, whole) if shared else []
        exact = [(doc, bucket, source, np.array([(a, p), (b - K, p + b - a - K)], np.int32).tobytes()) for _, a, b, doc, source, p, bucket in found]
        return pa.concat_tables([_chain_rows(table, fuzzy, False), _chain_rows(table, exact, True), _chain_rows(table, held, None)])

    return run


def chain(place: list[int], source: list[int]) -> list[list[int]]:
    """Chains of matches, best first, as lists of indexes; both lists are sorted by place, then source.

    A chain's score is K per match less GAP_COST per word by which the places move on, on either side.
    """
    n, reach = len(place), MOST_GAP + K
    if n == 1:
        return [[0]]
    score, back = [0.0] * n, [-1] * n
    if all(map(lt, place, place[1:])) and all(map(lt, source, source[1:])):
        # each match follows the last: no earlier one is nearer on either side, nor scores more
        score[0] = K
        for i in range(1, n):
            score[i] = K
            if place[i] - place[i - 1] <= reach and source[i] - source[i - 1] <= reach:
                gained = score[i - 1] + GAP_COST * (place[i - 1] + source[i - 1]) - GAP_COST * (place[i] + source[i])
                if gained > 0:
                    score[i], back[i] = K + gained, i - 1
        return _apart(score, back)
    ordered = sorted(set(source))
    ranks = {s: i + 1 for i, s in enumerate(ordered)}
    size, none = len(ordered), (float("-inf"), -1)
    # Fenwick tree for maxima of (score + GAP_COST * (place + source), index) over the matches within reach;
    # live has those of each source place that no later one surpasses, the oldest and best first
    tree, live = [none] * (size + 1), [deque() for _ in range(size + 1)]
    at = oldest = 0
    while at < n:
        stop = at
        while stop < n and place[stop] == place[at]:
            stop += 1
        while place[at] - place[oldest] > reach:
            r = ranks[source[oldest]]
            if live[r][0][1] == oldest:
                live[r].popleft()
                while r <= size:
                    if tree[r][1] == oldest:
                        best, step = live[r][0] if live[r] else none, 1
                        while step < r & -r:
                            best = max(best, tree[r - step])
                            step *= 2
                        tree[r] = best
                    r += r & -r
            oldest += 1
        for i in range(at, stop):  # matches at one place don't follow each other
            best, r, low = none, ranks[source[i]] - 1, bisect_left(ordered, source[i] - reach)
            while r > low:
                if r - (r & -r) >= low:
                    best = max(best, tree[r])
                    r -= r & -r
                else:
                    if live[r]:
                        best = max(best, live[r][0])
                    r -= 1
            gained = best[0] - GAP_COST * (place[i] + source[i])
            if gained > 0:
                score[i], back[i] = K + gained, best[1]
            else:
                score[i] = K
        for i in range(at, stop):
            value, r = (score[i] + GAP_COST * (place[i] + source[i]), i), ranks[source[i]]
            while live[r] and live[r][-1] < value:
                live[r].pop()
            live[r].append(value)
            while r <= size:
                tree[r] = max(tree[r], value)
                r += r & -r
        at = stop
    return _apart(score, back)


def _apart(score: list[float], back: list[int]) -> list[list[int]]:
    """Chains without a match in common, from the best score and each match's predecessor."""
    used, found = [False] * len(score), []
    for i in sorted(range(len(score)), key=lambda x: -score[x]):
        if used[i]:
            continue
        one = []
        while i >= 0 and not used[i]:
            used[i] = True
            one.append(i)
            i = back[i]
        found.append(one[::-1])
    return found


def _rows_by_key(table: pa.Table) -> dict:
    by: dict = {}
    for i, k in enumerate(table.column("key").to_pylist()):
        by.setdefault(k, []).append(i)
    return by


def _fetched(table: pa.Table, wanted: pa.Table) -> pa.Table:
    """For each chain the source's words around it; rows of seeds pass."""
    by = _rows_by_key(table)
    held = wanted.filter(pc.is_null(wanted.column("exact")))
    wanted = wanted.filter(pc.is_valid(wanted.column("exact")))
    need = sorted({i for s in set(wanted.column("source").to_pylist()) for i in by.get(s, [])})
    words, owners = wordhash.word_hashes(exchange.texts_of(table.take(pa.array(need, pa.int64()))))
    edges = np.searchsorted(owners, np.arange(len(need) + 1))
    where = {i: (edges[k], edges[k + 1]) for k, i in enumerate(need)}
    start, cut = [], []
    for s, raw in zip(wanted.column("source").to_pylist(), wanted.column("anchors").to_pylist(), strict=True):
        anchors = np.frombuffer(raw, np.int32).reshape(-1, 2)
        # with a repeated id: the longest of its texts
        low, high = max((where[i] for i in by.get(s, [])), key=lambda x: x[1] - x[0], default=(0, 0))
        a = max(0, int(anchors[0, 1]) - MARGIN)
        b = int(anchors[-1, 1]) + K + MARGIN
        start.append(a)
        cut.append((words[low + a : min(high, low + b)] >> np.uint64(32)).astype(np.uint32).tobytes())
    found = wanted.append_column("from", pa.array(start, pa.int32())).append_column("words", pa.array(cut, pa.binary()))
    return pa.concat_tables([found, held.append_column("from", pa.nulls(held.num_rows, pa.int32())).append_column("words", pa.nulls(held.num_rows, pa.binary()))])


def _edit_distance(a: list[int], b: list[int]) -> int:
    f, t, u = 0, len(a), len(b)
    while f < t and f < u and a[f] == b[f]:
        f += 1
    while t > f and u > f and a[t - 1] == b[u - 1]:
        t, u = t - 1, u - 1
    a, b = a[f:t], b[f:u]
    if len(a) < 2 or len(b) < 2 or set(a).isdisjoint(b):
        return max(len(a), len(b)) - (min(len(a), len(b)) == 1 and not set(a).isdisjoint(b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


_STEPS = ((1, 1), (1, 0), (0, 1), (2, 0), (0, 2), (2, 2), (3, 0), (0, 3))


def _extend(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """How far two sequences agree from their starts: lengths on both sides and equal words there.

    An edit costs two equal words; the extension ends where the best sum was reached. Words may be
    replaced, or up to three of them missing on one side.
    """
    i = j = equal = value = most = 0
    best, size, other_size = (0, 0, 0), len(a), len(b)
    while i < size and j < other_size and value > most - 8:
        if a[i] == b[j]:
            i, j, equal, value = i + 1, j + 1, equal + 1, value + 1
            if value > most:
                most, best = value, (i, j, equal)
            continue
        for di, dj in _STEPS:
            x, y = i + di, j + dj
            if x < size and y < other_size and a[x] == b[y] and a[x + 1 : x + 2] == b[y + 1 : y + 2]:
                break
        else:
            di = dj = 1
        i, j, value = i + di, j + dj, value - 2 * max(di, dj)
    return best


def align(own: np.ndarray, other: np.ndarray, anchors: Sequence[tuple[int, int]], min_words: int = 0, identity: float = 0.0) -> tuple[int, int, int, int, int]:
    """Bounds of the passage in both sequences, and how many of its words agree.

    If it has fewer words than ``min_words``, or by bounds too few that agree, that number is a bound that is too small as well.
    """
    (p, q), *rest = anchors
    equal, gaps = K, []
    end, other_end = p + K, q + K
    for x, y in rest:
        # overlapping seeds, or a gap: equal, or with edits
        shift = max(end - x, other_end - y, 0)
        if shift >= K:
            continue
        gap = x + shift - end
        if gap == y + shift - other_end and (not gap or (own[end : x + shift] == other[other_end : y + shift]).all()):
            equal += gap
        else:
            gaps.append((end, x + shift, other_end, y + shift))
        equal += K - shift
        end, other_end = x + K, y + K
    right = _extend(own[end : end + MARGIN].tolist(), other[other_end : other_end + MARGIN].tolist())
    left = _extend(own[max(0, p - MARGIN) : p][::-1].tolist(), other[max(0, q - MARGIN) : q][::-1].tolist())
    start, stop, other_start, other_stop, equal = p - left[0], end + right[0], q - left[1], other_end + right[1], equal + left[2] + right[2]
    most = equal + sum(min(t - f, u - g) for f, t, g, u in gaps)
    if stop - start < min_words or most < identity * max(stop - start, other_stop - other_start):
        return start, stop, other_start, other_stop, most
    for f, t, g, u in gaps:
        a, b = own[f:t].tolist(), other[g:u].tolist()
        equal += max(0, max(len(a), len(b)) - _edit_distance(a, b))
    return start, stop, other_start, other_stop, equal


PASSAGE = T.StructType([T.StructField(n, t) for n, t in (("source", T.LongType()), ("start", T.IntegerType()), ("end", T.IntegerType()), ("source_start", T.IntegerType()), ("source_end", T.IntegerType()), ("agreeing", T.IntegerType()))])


def _without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the given ranges of words; each goes with the separators after it."""
    words = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : words[a][0]])
        at = words[b][0] if b < len(words) else len(raw)
    return b"".join([*out, raw[at:]])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


#: Fields of a passage, as travel in Arrow.
_PASSAGE = pa.struct([(n, pa.int64() if n == "source" else pa.int32()) for n in PASSAGE.names])


def _own_words(table: pa.Table, docs: set) -> tuple[dict, dict[int, np.ndarray]]:
    """The rows of each key, and the words, as 32-bit hashes, of the rows of the given ones."""
    by = _rows_by_key(table)
    need = sorted({i for d in docs for i in by.get(d, [])})
    words, owners = wordhash.word_hashes(exchange.texts_of(table.take(pa.array(need, pa.int64()))))
    words = (words >> np.uint64(32)).astype(np.uint32)
    edges = np.searchsorted(owners, np.arange(len(need) + 1))
    return by, {i: words[edges[k] : edges[k + 1]] for k, i in enumerate(need)}


def _passages(chains: pa.Table, by: dict, own_of: dict[int, np.ndarray], min_words: int, identity: float) -> tuple[dict[int, list[dict]], dict[int, list[tuple[int, int]]]]:
    """Of each row of a bucket the passages that its chains make, and the words that they cover."""
    found: dict[int, list[dict]] = {}
    covered: dict[int, list[tuple[int, int]]] = {}
    # the longest chains first, exact windows last: what they hold is mostly covered by then
    chains = chains.append_column("size", pc.negate(pc.binary_length(chains.column("anchors")))).sort_by([("exact", "ascending"), ("size", "ascending"), ("doc", "ascending"), ("source", "ascending"), ("anchors", "ascending")])
    for doc, source, raw, start, cut, exact in zip(*(chains.column(c).to_pylist() for c in ("doc", "source", "anchors", "from", "words", "exact")), strict=True):
        anchors = np.frombuffer(raw, np.int32).reshape(-1, 2).astype(np.int64) - np.array([0, start])
        other = np.frombuffer(cut, np.uint32)
        for i in by.get(doc, []):
            own = own_of[i]
            if anchors[-1, 0] + K > len(own) or anchors[-1, 1] + K > len(other) or not (own[anchors[0, 0] : anchors[0, 0] + K] == other[anchors[0, 1] : anchors[0, 1] + K]).all():
                continue  # another text of the same id
            if any(a <= anchors[0, 0] and anchors[-1, 0] + K <= b for a, b in covered.get(i, []) if exact) or any(p["source"] == source and p["start"] <= anchors[0, 0] and anchors[-1, 0] + K <= p["end"] for p in found.get(i, [])):
                continue
            a, b, c, d, equal = align(own, other, anchors.tolist(), min_words, identity)
            if b - a >= min_words and equal >= identity * max(b - a, d - c):
                found.setdefault(i, []).append({"source": source, "start": a, "end": b, "source_start": c + start, "source_end": d + start, "agreeing": equal})
                covered[i] = _merged([*covered.get(i, []), (a, b)])
    return found, covered


class _Search:
    """What all steps of one search share: the dealt texts, their columns, and the chains with first holders."""

    def __init__(self, docs: DataFrame, key: str, text: str, min_words: int, shared: bool):
        self.kept = [f for f in docs.schema.fields if f.name.lower() not in ("cleaned", "passages")]
        #: where each kept column travels; the text, the dear one, only once
        self.at = ["text" if f.name.lower() == text.lower() and f.dataType == T.StringType() else f"_{i}" for i, f in enumerate(self.kept)]
        carried = [F.col(f"`{f.name}`").alias(at) for f, at in zip(self.kept, self.at, strict=True) if at != "text"]
        wanted = [F.col(key).cast("long").alias("key"), F.col(text).alias("text")]
        rows = docs.select(*carried, *wanted, F.xxhash64(wanted[0], wanted[1]).alias("mark"))
        self.dealt, self.n = exchange.dealt(rows, "key", "text", carry=[a for a in self.at if a != "text"] + ["mark"])
        self.bits = bits = wordhash.key_bits(self.n)
        answers = exchange.exchange(self.dealt, self.n, lambda table: _asked_seeds(table, bits), bits, merge=exchange.first_holder)
        row = "bucket int, doc long, source_bucket int, source long, anchors binary, exact boolean, mark long, held binary"
        size = max(min_words, K)
        ask = exchange.asking(self.n, _asked_windows(size, bits))
        asked = _by(self.dealt).cogroup(_by(answers)).applyInArrow(lambda table, replies: ask(table, replies), exchange.REQUEST)
        holders = exchange.answered(asked, self.n, exchange.first_holder)
        both = answers.withColumn("seeds", F.lit(True)).unionByName(holders.withColumn("seeds", F.lit(False)))
        chains = _by(self.dealt).cogroup(_by(both)).applyInArrow(_chains(size, bits, shared), row)
        self.fetched = _by(self.dealt).cogroup(_by(chains, "source_bucket")).applyInArrow(_fetched, f"{row}, from int, words binary")
        self.schema = T.StructType([*self.kept, T.StructField("cleaned", T.StringType()), T.StructField("passages", T.ArrayType(PASSAGE))])

    def cut(self) -> Callable[[pa.Table, dict[int, list[dict]]], pa.Table]:
        """From a bucket's texts, and the passages of each row, to the result."""
        names, at = [f.name for f in self.kept], self.at

        def run(table: pa.Table, found: dict[int, list[dict]]) -> pa.Table:
            texts = table.column("text").to_pylist()
            for i, passages in found.items():
                texts[i] = _without(texts[i].encode(), _merged([(p["start"], p["end"]) for p in passages])).decode()
            return pa.table({n: table.column(a) for n, a in zip(names, at, strict=True)} | {"cleaned": pa.array(texts, pa.string()), "passages": pa.array([found.get(i, []) for i in range(table.num_rows)], pa.list_(_PASSAGE))})

        return run


def _by(df: DataFrame, column: str = "bucket") -> GroupedData:
    return df.groupBy(column)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50, identity: float = 0.8) -> DataFrame:
    """``docs`` with ``cleaned`` and ``passages``, by steps 1 to 5 alone: each seed is compared with its first holder only."""
    plan = _Search(docs, key, text, min_words, shared=False)
    cut = plan.cut()

    def aligned(table: pa.Table, chains: pa.Table) -> pa.Table:
        by, own_of = _own_words(table, set(chains.column("doc").to_pylist()))
        return cut(table, _passages(chains, by, own_of, min_words, identity)[0])

    return _by(plan.dealt).cogroup(_by(plan.fetched)).applyInArrow(aligned, plan.schema)


# ---- step 6: all other holders of seeds outside what is cut ---------------------------------------------


def _reached(place: np.ndarray, row: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of all pairs of different seeds of a row, sorted by row and place, of which a chain can hold one after the other."""
    at = (row.astype(np.int64) << 32) + place
    for a in range(0, len(at), _PIECE):
        n = np.searchsorted(at, at[a : a + _PIECE] + (MOST_GAP + K), "right") - np.arange(a, min(len(at), a + _PIECE)) - 1
        i = np.repeat(np.arange(a, a + len(n)), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        use = key[i] != key[j]
        yield i[use], j[use]


_HELD = "bucket int, doc long, mark long, passages array<struct<source long, start int, end int, source_start int, source_end int, agreeing int>>, held binary, places binary, open binary, size long"


def _opened(min_words: int, identity: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From a bucket's texts and fetched chains to ``_HELD``: the passages of each text, its seeds that others hold, which of them aren't wholly cut (1) and which earlier documents hold (2), and its number of words."""

    def run(table: pa.Table, fetched: pa.Table) -> pa.Table:
        chains = fetched.filter(pc.is_valid(fetched.column("exact")))
        held = fetched.filter(pc.is_null(fetched.column("exact")))
        by, own_of = _own_words(table, set(fetched.column("doc").to_pylist()))
        found, covered = _passages(chains, by, own_of, min_words, identity)
        marks = table.column("mark").to_pylist()
        row_of = {(d, marks[i]): i for d, rows in by.items() for i in rows if i in own_of}
        seeds_of = {(d, m): (raw, np.cumsum(exchange.unpacked(places, np.int32))) for d, m, raw, places in zip(*(held.column(c).to_pylist() for c in ("doc", "mark", "held", "anchors")), strict=True)}
        out = []
        for (d, m), i in sorted(row_of.items()):
            if (d, m) not in seeds_of:
                if i in found:
                    out.append((d, m, found[i], None, None, None, None))
                continue
            raw, places = seeds_of[d, m]
            places, earlier = places >> 1, places & 1
            spans = np.array(covered.get(i, []), np.int64).reshape(-1, 2)
            k = np.searchsorted(spans[:, 0], places, "right") - 1
            left = ~((k >= 0) & (places + K <= spans[np.maximum(k, 0), 1])) if len(spans) else np.ones(len(places), bool)
            out.append((d, m, found.get(i, []), raw, exchange.packed(np.diff(places, prepend=0).astype(np.int32)), (left + 2 * earlier).astype(np.uint8).tobytes(), len(own_of[i])))
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.list_(_PASSAGE), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
        names = ("doc", "mark", "passages", "held", "places", "open", "size")
        return pa.table({"bucket": pa.array([bucket] * len(out), pa.int32())} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return run


def _seed_table(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of ``_HELD`` rows: row, place, key and state of each seed, and whether a pair with it asks."""
    rows = [(i, h, p, o) for i, (h, p, o) in enumerate(zip(*(table.column(c).to_pylist() for c in ("held", "places", "open")), strict=True)) if h]
    row = np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[3]) for r in rows])
    key = np.concatenate([np.empty(0, np.uint64), *(exchange.unpacked(r[1], np.uint64) for r in rows)])
    place = np.concatenate([np.empty(0, np.int64), *(np.cumsum(exchange.unpacked(r[2], np.int32), dtype=np.int64) for r in rows)])
    state = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    asks = np.zeros(len(row), bool)
    for i, j in _reached(place, row, key):
        either = _asking(state, i, j)
        asks[i[either]] = asks[j[either]] = True
    return row, place, key, state, asks


def _asking(state: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of seeds are held earlier, both, and not wholly cut, one of them."""
    return ((state[i] & state[j] & 2) > 0) & (((state[i] | state[j]) & 1) > 0)


_NONE = np.iinfo(np.int64).min


def greatest(values: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The merge for the greatest value of each key."""
    return np.maximum.reduceat(values[:, np.argsort(place, kind="stable")], starts, axis=1)


def _asked_open(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct seeds of ``_HELD`` rows, and the last document that asks for other holders of each."""
    row, _, key, _, asks = _seed_table(table)
    doc = table.column("doc").to_numpy()
    value = np.where(asks, doc[row], _NONE) if len(row) else np.empty(0, np.int64)
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    last = np.flatnonzero(np.concatenate((key[1:] != key[:-1], [True]))) if len(key) else np.empty(0, np.int64)
    return key[last], value[last]


def _pair_keys(key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return wordhash.mix(key[i] * np.uint64(0xD6E8FEB86659FD93) + wordhash.mix(key[j])).view(np.int64)


def _pairs(table: pa.Table, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From ``_HELD`` rows and the last documents that ask for each seed to pairs of seeds, once a text, of those that ask and of earlier holders: pair, row, whether it asks."""
    row, place, key, state, asks = _seed_table(table)
    doc = table.column("doc").to_numpy()
    distinct = np.unique(key)
    last = exchange.received(replies, len(distinct))[0][np.searchsorted(distinct, key)] if len(key) else np.empty(0, np.int64)
    part = np.flatnonzero(asks | (doc[row] < last))
    row, place, key, state, last = row[part], place[part], key[part], state[part], last[part]
    pair, of, either = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
    for i, j in _reached(place, row, key):
        ask = _asking(state, i, j)
        use = ask | (doc[row[i]] < np.minimum(last[i], last[j]))
        pair.append(_pair_keys(key, i[use], j[use]))
        of.append(row[i[use]])
        either.append(ask[use])
    pairs, rows, ask = np.concatenate(pair), np.concatenate(of), np.concatenate(either)
    order = np.lexsort((rows, pairs.view(np.uint64)))
    pairs, rows, ask = pairs[order], rows[order], ask[order]
    first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (pairs[1:] != pairs[:-1])))) if len(rows) else np.empty(0, np.int64)
    return pairs[first], rows[first], np.logical_or.reduceat(ask, first) if len(first) else ask


def pooled(values: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The merge for what is known of a pair's texts: the last that asks, the least, their hash, number and bytes."""
    values = values[:, np.argsort(place, kind="stable")]
    return np.stack([how.reduceat(v, starts) for how, v in zip((np.maximum, np.minimum, np.bitwise_xor, np.add, np.add), values, strict=True)])


def _asked_pairs(table: pa.Table, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of ``_pairs``, and for ``pooled`` what the bucket knows of each."""
    pairs, rows, ask = _pairs(table, replies)
    if not len(pairs):
        return np.empty(0, np.uint64), np.empty((5, 0), np.int64)
    doc, mark = table.column("doc").to_numpy()[rows], table.column("mark").to_numpy()[rows]
    starts = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    values = np.stack((np.where(ask, doc, _NONE), doc, wordhash.mix(mark.view(np.uint64)).view(np.int64), np.ones(len(doc), np.int64), table.column("size").fill_null(0).to_numpy()[rows] * 4))
    return pairs[starts].view(np.uint64), pooled(values, np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [len(pairs)])))), starts)


_MEMBER = "bucket int, doc long, mark long, held binary, places binary, open binary, groups array<struct<texts long, n long, blocks int, pairs array<bigint>>>"


def _members(block_bytes: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From ``_HELD`` rows and the answers to both questions to the texts that are compared with others, and in which groups.

    Pairs of seeds that the same texts hold make one group.
    """
    kind = pa.list_(pa.struct([("texts", pa.int64()), ("n", pa.int64()), ("blocks", pa.int32()), ("pairs", pa.list_(pa.int64()))]))

    def run(table: pa.Table, both: pa.Table) -> pa.Table:
        pairs, rows, ask = _pairs(table, both.filter(both.column("seeds")))
        distinct = np.unique(pairs.view(np.uint64))
        of: dict[int, dict[tuple[int, int, int], list[int]]] = {}
        if len(pairs):
            last, least, texts, n, total = exchange.received(both.filter(pc.invert(both.column("seeds"))), len(distinct))[:, np.searchsorted(distinct, pairs.view(np.uint64))]
            use = (last > least) & (ask | (table.column("doc").to_numpy()[rows] < last))
            for i, pair, *group in zip(*(x[use].tolist() for x in (rows, pairs, texts, n, -(-total // block_bytes))), strict=True):
                of.setdefault(i, {}).setdefault(tuple(group), []).append(pair)
        at = sorted(of)
        groups = [[{"texts": g[0], "n": g[1], "blocks": g[2], "pairs": sorted(held)} for g, held in of[i].items()] for i in at]
        return table.select(["bucket", "doc", "mark", "held", "places", "open"]).take(pa.array(at, pa.int64())).append_column("groups", pa.array(groups, kind))

    return run


_BLOCK = "texts long, n long, a int, b int, own int, bucket int, doc long, mark long, pairs binary, held binary, places binary, open binary, words binary, start int"


def _into_blocks(table: pa.Table, members: pa.Table) -> pa.Table:
    """Of each text, to all the blocks of its groups that it is in, the part that chains with a pair of the group can be in."""
    by, own_of = _own_words(table, set(members.column("doc").to_pylist()))
    marks = table.column("mark").to_pylist()
    rows = []
    for member in members.to_pylist():
        words = next(own_of[i] for i in by[member["doc"]] if marks[i] == member["mark"])
        key, place, state = exchange.unpacked(member["held"], np.uint64), np.cumsum(exchange.unpacked(member["places"], np.int32), dtype=np.int64), np.frombuffer(member["open"], np.uint8)
        # no chain goes over a longer gap between seeds
        stretch = np.concatenate(([0], np.cumsum(np.diff(place) > MOST_GAP + K)))
        spots = [(_pair_keys(key, i, j), stretch[i]) for i, j in _reached(place, np.zeros(len(place), np.int64), key)]
        pair, of = (np.concatenate([x[c] for x in spots]) for c in (0, 1))
        hashed = wordhash.mix(np.array([member["mark"]], np.int64).view(np.uint64))[0]
        for group in member["groups"]:
            used = of[np.isin(pair, group["pairs"])]
            part = (stretch >= used.min()) & (stretch <= used.max())
            at = place[part]
            start, blocks = max(0, int(at[0]) - MARGIN), max(1, group["blocks"])
            own = int(hashed % np.uint64(blocks))
            one = (own, member["bucket"], member["doc"], member["mark"], np.array(group["pairs"], np.int64).tobytes(), key[part].tobytes(), (at - start).astype(np.int32).tobytes(), state[part].tobytes(), words[start : at[-1] + K + MARGIN].tobytes(), start)
            rows += [(group["texts"], group["n"], min(own, o), max(own, o), *one) for o in range(blocks)]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in _BLOCK.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for c, (n, k) in zip(columns, fields, strict=True)})


_PAD = np.int64(1 << 33)
_OWN, _THEIR = np.array(_STEPS).T


def extensions(a: np.ndarray, words: np.ndarray, start: np.ndarray, length: np.ndarray, sign: int, few: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_extend`` of one sequence with many: those of the given lengths that start in ``words`` and go on in the direction ``sign``; with a ``few`` one by one."""
    if len(start) <= few:
        mine, found = a.tolist(), []
        for f, n in zip(start.tolist(), length.tolist(), strict=True):
            found.append(_extend(mine, (words[f : f + n] if sign > 0 else words[f - n + 1 : f + 1][::-1]).tolist()))
        i, j, equal = np.array(found, np.int64).reshape(-1, 3).T
        return i, j, equal
    a = np.concatenate((a.astype(np.int64), np.full(6, _PAD)))
    size, n = len(a) - 6, len(start)
    i, j, equal, value, best = (np.zeros(n, np.int64) for _ in range(5))
    ends = np.zeros((3, n), np.int64)
    ahead = np.arange(5)[:, None]

    def other(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = at < length[rows]
        return np.where(inside, words[np.where(inside, start[rows] + sign * at, 0)], _PAD)

    alive = np.flatnonzero(length > 0) if size else np.empty(0, np.int64)
    while len(alive):
        same = a[i[alive]] == other(alive, j[alive])
        s, t = alive[same], alive[~same]
        for x in (i, j, equal, value):
            x[s] += 1
        s = s[value[s] > best[s]]
        best[s] = value[s]
        ends[:, s] = i[s], j[s], equal[s]
        if len(t):
            own, their = a[i[t] + ahead], other(t, j[t] + ahead)
            fits = (own[_OWN] == their[_THEIR]) & (own[_OWN + 1] == their[_THEIR + 1]) & (own[_OWN] != _PAD)
            step = np.where(fits.any(axis=0), fits.argmax(axis=0), 0)  # none fits: one word on, as the first step
            i[t] += _OWN[step]
            j[t] += _THEIR[step]
            value[t] -= 2 * np.maximum(_OWN, _THEIR)[step]
        alive = alive[(i[alive] < size) & (j[alive] < length[alive]) & (value[alive] > best[alive] - 8)]
    return ends[0], ends[1], ends[2]


def _twos(words: np.ndarray) -> np.ndarray:
    """All pairs of neighbouring words, as 64 bits."""
    words = words.astype(np.uint64)
    return words[:-1] << np.uint64(32) | words[1:]


def _compared(min_words: int, identity: float) -> Callable[[pa.Table], pa.Table]:
    """Of a block, the passages of texts that ask with all earlier documents that hold one of their pairs of seeds.

    Every place where a text has the pair is compared with the first one where the other has it.
    What is around a pair is extended for all holders at once. Where that is too short or agrees too little,
    and no other common seed is near, no chain makes a passage; all other holders are chained and aligned.
    """
    reach = MOST_GAP + K

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc", "ascending"), ("mark", "ascending")])
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        own, doc = table.column("own").to_numpy(), table.column("doc").to_numpy()
        read = lambda column, kind: [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
        texts, keys, places, states = read("words", np.uint32), read("held", np.uint64), read("places", np.int32), read("open", np.uint8)
        left = [(x & 1).astype(bool) for x in states]
        size = np.array([len(w) for w in texts])
        shift = table.column("start").to_numpy()
        flat, base = np.concatenate(texts).astype(np.int64), np.concatenate(([0], np.cumsum(size)[:-1]))
        # all spots of the group's pairs: pair, row, places, and whether they ask
        key, place, state, row = np.concatenate(keys), np.concatenate(places).astype(np.int64), np.concatenate(states), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        pairs, some = np.unique(np.concatenate(read("pairs", np.int64))), []
        for i, j in _reached(place, row, key):
            pair = _pair_keys(key, i, j)
            use = np.flatnonzero(pairs[np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)] == pair)
            i, j = i[use], j[use]
            some.append((pair[use], row[i], place[i], place[j], _asking(state, i, j)))
        at = np.column_stack([np.concatenate(c) for c in zip(*some, strict=True)])
        asking = at[at[:, 4] > 0]
        asking = asking[np.lexsort((asking[:, 3], asking[:, 2], asking[:, 1]))]
        # in other documents a pair is where it is first
        at = at[np.lexsort((at[:, 3], at[:, 2], at[:, 1], at[:, 0]))]
        at = at[np.concatenate(([True], (at[1:, 0] != at[:-1, 0]) | (at[1:, 1] != at[:-1, 1])))]
        of_pairs = at[:, 1].copy()
        edges = np.searchsorted(asking[:, 1], np.arange(len(keys) + 1))
        cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], at[1:, 0] != at[:-1, 0]))), [len(at)]))
        slices = {pair: (f, t) for pair, f, t in zip(at[cuts[:-1], 0].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}
        # all seeds by key, then row
        seed_key, seed_row = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        order = np.lexsort((seed_row, seed_key))
        seed_key, seed_row = seed_key[order], seed_row[order]
        out = []
        sides: dict[int, list[tuple]] = {}
        kinds: dict[int, np.ndarray] = {}
        firsts: dict[int, tuple] = {}

        def run_of(own: np.ndarray, other: np.ndarray) -> int:
            n = min(len(own), len(other))
            differ = np.flatnonzero(own[:n] != other[:n])
            return int(differ[0]) if len(differ) else n

        def side(first: np.ndarray, sign: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
            """The words beside one of many spots; how many of them each has; and by that number the next eight words of each."""
            length, best, runs = np.clip(length, 0, MARGIN), np.empty(0, np.int64), np.full(len(first), -1)
            for one in {0, len(first) // 3, len(first) // 2, len(first) - 1}:
                words = flat[first[one] + sign * np.arange(length[one])]
                run, alive = np.zeros(len(first), np.int64), np.arange(len(first))
                for k in range(len(words)):
                    alive = alive[length[alive] > k]
                    alive = alive[flat[first[alive] + sign * k] == words[k]]
                    run[alive] += 1
                if np.sort(run)[len(run) // 4 :].clip(max=20).sum() > np.sort(runs)[len(run) // 4 :].clip(max=20).sum():
                    best, runs = words, run
            following = {}
            for n in np.unique(runs).tolist():
                spot = np.flatnonzero(runs == n)
                inside = n + np.arange(8) < length[spot][:, None]
                words = flat[np.where(inside, first[spot][:, None] + sign * (n + np.arange(8)), 0)][inside]
                order = np.argsort(words, kind="stable")
                following[n] = spot, words[order], spot[np.nonzero(inside)[0]][order]
            return best, runs, following

        def likely(mine: np.ndarray, p: int, p2: int, pair: int, some: np.ndarray) -> np.ndarray:
            """Which spots of a pair can make enough words: where the texts differ, an extension goes on if one of the eight next words is equal."""
            if pair not in sides:
                j, q, q2 = some[:, 1], some[:, 2], some[:, 3]
                sides[pair] = [side(base[j] + q2 + K, 1, size[j] - q2 - K), side(base[j] + q - 1, -1, q)]
            total, found = np.full(len(some), p2 + K - p), np.zeros(len(some), bool)
            for (words, runs, following), own in zip(sides[pair], (mine[p2 + K : p2 + K + MARGIN], mine[max(0, p - MARGIN) : p][::-1]), strict=True):
                own = own.astype(np.int64)
                mutual = run_of(own, words)
                total += runs
                for n, (spot, next_words, of) in following.items():
                    if n > mutual:
                        found[spot] = True
                        continue
                    wanted = np.unique(own[n : n + 8])
                    for x, y in zip(np.searchsorted(next_words, wanted, "left").tolist(), np.searchsorted(next_words, wanted, "right").tolist(), strict=True):
                        found[of[x:y]] = True
            return found | (total >= min_words)

        def words_in(k: int) -> np.ndarray:
            if k not in kinds:
                kinds[k] = np.unique(texts[k])
            return kinds[k]

        def spots_in(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in firsts:
                one = _first_spots(keys[k], places[k])
                firsts[k] = keys[k][one], places[k][one]
            return firsts[k]

        # of n words (1 - identity) * n on each side may differ, and each of these part two runs of equal ones
        least = (3 * identity - 2) * min_words - 1
        two, two_row = (np.concatenate(x) for x in ([_twos(t) for t in texts], [np.full(max(0, len(t) - 1), k) for k, t in enumerate(texts)]))
        order = np.argsort(two, kind="stable")
        two, two_row = two[order], two_row[order]
        new = np.concatenate(([True], (two[1:] != two[:-1]) | (two_row[1:] != two_row[:-1])))[: len(two)]
        two, two_row = two[new], two_row[new]

        def alien(mine: np.ndarray) -> np.ndarray:
            """Which texts have fewer pairs of words in common with one than a passage has."""
            if least <= 0:
                return np.zeros(len(texts), bool)
            mine, times = exchange.summed(_twos(mine))
            lows, many = np.searchsorted(two, mine, "left"), np.searchsorted(two, mine, "right")
            many -= lows
            rows = two_row[np.repeat(lows - np.cumsum(many) + many, many) + np.arange(many.sum())]
            return np.bincount(rows, np.repeat(times, many), len(texts)) < least - 1e-9

        def possible(mine: np.ndarray, k: int) -> bool:
            """Whether two texts have as many words in common as a passage has."""
            words = words_in(k)
            return (words[np.minimum(np.searchsorted(words, mine), len(words) - 1)] == mine).sum() >= identity * min_words

        for r in np.flatnonzero(np.diff(edges)).tolist():
            mine, hits = texts[r], None
            covered: list[tuple[int, int]] = []
            # later documents, those of other blocks, and those that were aligned with this one
            weighed, counted = np.zeros(len(doc), bool), False
            done = (doc >= doc[r]) | ((a != b) & (own == own[r]))
            low, high, their_low, their_high = (np.full(len(doc), v) for v in (1 << 40, -1, 1 << 40, -1))
            open_at = np.sort(places[r][left[r]]).astype(np.int64)

            def settled(x: int) -> bool:
                k = int(np.searchsorted(open_at, x))
                return k == len(open_at) or open_at[k] != x or any(f <= x and x + K <= t for f, t in covered)  # noqa: B023

            for pair, _, p, p2, _ in asking[edges[r] : edges[r + 1]].tolist():
                f, t = slices[pair]
                holders = of_pairs[f:t]
                if done[holders].all() or (settled(p) and settled(p2)):
                    continue
                if not counted:
                    counted, done = True, done | alien(mine)
                    if done.all():
                        break
                free = ~done[holders]
                if t - f <= 30:
                    for k in holders[free & ~weighed[holders]].tolist():
                        weighed[k], done[k] = True, not possible(mine, k)
                    free = ~done[holders]
                if not free.any():
                    continue
                if hits is None:
                    lows, highs = np.searchsorted(seed_key, keys[r], "left"), np.searchsorted(seed_key, keys[r], "right")
                    many = highs - lows
                    hits = seed_row[np.repeat(lows - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())], np.repeat(places[r].astype(np.int64), many)
                j, q, q2 = holders[free], at[f:t, 2][free], at[f:t, 3][free]
                fresh = ~((low[j] <= p) & (p2 + K <= high[j]) & (their_low[j] <= q) & (q2 + K <= their_high[j]))
                if not fresh.any():
                    continue
                # common seeds about, by place
                edge = np.searchsorted(hits[1], (p - MARGIN - reach - K, p, p2 + 1, p2 + K + MARGIN + reach + 1))
                row, x = (np.concatenate((c[edge[0] : edge[1]], c[edge[2] : edge[3]])) for c in hits)
                if p2 + K - p < min_words and fresh.sum() > 30:
                    about = np.zeros(len(doc), bool)
                    about[row] = True
                    fresh &= likely(mine, p, p2, pair, at[f:t])[free] | about[j]
                    if not fresh.any():
                        continue
                j, q, q2 = j[fresh], q[fresh], q2[fresh]
                right = extensions(mine[p2 + K : p2 + K + MARGIN], flat, base[j] + q2 + K, np.clip(size[j] - q2 - K, 0, MARGIN), 1)
                back = extensions(mine[max(0, p - MARGIN) : p][::-1], flat, base[j] + q - 1, np.minimum(q, MARGIN), -1)
                start, end, their_start, their_end = p - back[0], p2 + K + right[0], q - back[1], q2 + K + right[1]
                most = np.minimum(p2 + K - p, q2 + K - q) + back[2] + right[2]
                able = (end - start >= min_words) & (most >= identity * np.maximum(end - start, their_end - their_start))
                able |= (right[0] == MARGIN) | (right[1] == MARGIN) | (back[0] == MARGIN) | (back[1] == MARGIN)
                low[j], high[j], their_low[j], their_high[j] = start, end, their_start, their_end
                near = ((x + K > high[row]) & (x <= high[row] + reach)) | ((x < low[row]) & (x + K + reach >= low[row]))
                others = np.bincount(row[near], minlength=len(doc)) > 0
                for k in j[able | others[j]].tolist():
                    if settled(p) and settled(p2):
                        break
                    done[k] = True
                    if t - f > 30 and not possible(mine, k):
                        continue
                    for passage in _passages_of(mine, keys[r], places[r], texts[k], *spots_in(k), min_words, identity):
                        if any(u <= passage[0] and passage[1] <= v for u, v in covered):
                            continue
                        covered = _merged([*covered, passage[:2]])
                        move = (int(shift[r]), int(shift[r]), int(shift[k]), int(shift[k]), 0)
                        out.append((r, {"source": int(doc[k])} | {n: v + m for n, v, m in zip(("start", "end", "source_start", "source_end", "agreeing"), passage, move, strict=True)}))
        at_row = pa.array([r for r, _ in out], pa.int64())
        return pa.table({"bucket": table.column("bucket").take(at_row), "doc": table.column("doc").take(at_row), "mark": table.column("mark").take(at_row), "passages": pa.array([[p] for _, p in out], pa.list_(_PASSAGE))})

    return run


def _first_spots(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The seeds of a text that are in the first spot of one of their pairs."""
    row, found = np.zeros(len(keys), np.int64), []
    for i, j in _reached(places.astype(np.int64), row, keys):
        found.append((_pair_keys(keys, i, j), places[i], i, j))
    spots = np.column_stack([np.concatenate(c) for c in zip(*found, strict=True)]) if found else np.empty((0, 4), np.int64)
    spots = spots[np.lexsort((spots[:, 3], spots[:, 1], spots[:, 0]))]
    return np.unique(spots[np.concatenate(([True], spots[1:, 0] != spots[:-1, 0]))[: len(spots)], 2:])


def _passages_of(own: np.ndarray, keys: np.ndarray, places: np.ndarray, other: np.ndarray, other_keys: np.ndarray, other_places: np.ndarray, min_words: int, identity: float) -> list[tuple[int, int, int, int, int]]:
    """The passages of a text with another, by all seeds that both hold."""
    both = np.flatnonzero(np.isin(other_keys, keys))
    both = both[np.argsort(other_keys[both], kind="stable")]
    sorted_keys = other_keys[both]
    low, high = np.searchsorted(sorted_keys, keys, "left"), np.searchsorted(sorted_keys, keys, "right")
    n = high - low
    q = other_places[both][np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
    p = np.repeat(places, n)
    found: list[tuple[int, int, int, int, int]] = []
    spots = list(zip(p.tolist(), q.tolist(), strict=True))
    chains = [[spots[i] for i in one] for one in chain(*map(list, zip(*spots, strict=True))) if len(one) >= LEAST_SEEDS] if spots else []
    for anchors in sorted(chains, key=lambda x: (-len(x), x)):
        if any(f <= anchors[0][0] and anchors[-1][0] + K <= t for f, t, *_ in found):
            continue
        f, t, c, d, equal = align(own, other, anchors, min_words, identity)
        if t - f >= min_words and equal >= identity * max(t - f, d - c):
            found.append((f, t, c, d, equal))
    return found


def search(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50, identity: float = 0.8, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``cleaned`` and ``passages``: see the module's description."""
    plan = _Search(docs, key, text, min_words, shared=True)
    held = _by(plan.dealt).cogroup(_by(plan.fetched)).applyInArrow(_opened(min_words, identity), _HELD)
    # all that follows reads one exchange of these rows
    ask = exchange.asking(plan.n, _asked_open, plan.bits)
    requests = _by(held).applyInArrow(lambda table: ask(table.sort_by([("doc", "ascending"), ("mark", "ascending")])), exchange.REQUEST)
    replies = exchange.answered(requests, plan.n, greatest, plan.bits)
    ask_pairs = exchange.asking(plan.n, _asked_pairs)
    pairs = exchange.answered(_by(held).cogroup(_by(replies)).applyInArrow(lambda table, more: ask_pairs(table, more), exchange.REQUEST), plan.n, pooled)
    both = replies.withColumn("seeds", F.lit(True)).unionByName(pairs.withColumn("seeds", F.lit(False)))
    members = _by(held).cogroup(_by(both)).applyInArrow(_members(block_bytes), _MEMBER)
    blocks = _by(plan.dealt).cogroup(_by(members)).applyInArrow(_into_blocks, _BLOCK)
    more = blocks.groupBy(F.struct("texts", "n", "a", "b")).applyInArrow(_compared(min_words, identity), _HELD.split(", held")[0])
    first = _by(held).applyInArrow(lambda table: table.select(["bucket", "doc", "mark", "passages"]), _HELD.split(", held")[0])
    found = first.withColumn("step", F.lit(0)).unionByName(more.withColumn("step", F.lit(1)))
    cut = plan.cut()

    def joined(table: pa.Table, found: pa.Table) -> pa.Table:
        of: dict[tuple[int, int], list[dict]] = {}
        rest: dict[tuple[int, int], list[dict]] = {}
        for doc, mark, passages, step in zip(*(found.column(c).to_pylist() for c in ("doc", "mark", "passages", "step")), strict=True):
            if passages:
                (rest if step else of).setdefault((doc, mark), []).extend(passages)
        for one, passages in rest.items():
            covered = _merged([(p["start"], p["end"]) for p in of.get(one, [])])
            for p in sorted(passages, key=lambda p: (p["start"] - p["end"], *p.values())):
                if not any(a <= p["start"] and p["end"] <= b for a, b in covered):
                    of.setdefault(one, []).append(p)
                    covered = _merged([*covered, (p["start"], p["end"])])
        rows = zip(table.column("key").to_pylist(), table.column("mark").to_pylist(), strict=True)
        return cut(table, {i: of[one] for i, one in enumerate(rows) if one in of})

    return _by(plan.dealt).cogroup(_by(found)).applyInArrow(joined, plan.schema)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", min_words: int = 50) -> DataFrame:
    """``docs`` with their passages that an earlier document holds cut from the text, and the new length.

    Documents of which no word is left go; those without such a passage stay as they are, empty ones too.
    """
    moved, back = set_aside(docs, ("cleaned", "passages"))
    found = search(moved, key, text, min_words)
    touched = F.size("passages") > 0
    kept = found.where(~touched | F.col("cleaned").rlike(r"[^\x20\x09-\x0D]"))
    new = {text: F.when(touched, F.col("cleaned")).otherwise(F.col(text))}
    if length in docs.columns:
        new[length] = F.when(touched, F.length("cleaned").cast(docs.schema[length].dataType)).otherwise(F.col(length))
    return back(kept.withColumns(new))
