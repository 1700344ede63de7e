"""String, set and vector similarities.

Edit-based ratios have no built-in; they are computed for all pairs of a batch in one Arrow UDF (string_scores), each
distinct pair once a batch and many pairs at a time (stretch_scores); the functions of two strings define the results. Everything else
is a native expression.

Conventions: ratios run from 0 to 100; two empty strings have ratio 100; token-set and partial ratios with an empty side
are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of a."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    only_x, only_y = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    with_x, with_y = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    best = ratio(with_x, with_y)
    if both:
        best = max(best, ratio(both, with_x), ratio(both, with_y))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against the stretches of the longer one of at most its length."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    best = _best_stretch(a, b)
    return max(best, _best_stretch(b, a)) if len(a) == len(b) else best


def _best_stretch(a: str, b: str) -> float:
    m = len(a)
    return max(ratio(a, b[max(0, end - m) : end]) for end in range(1, len(b) + m))


def jaro_winkler(a: str, b: str) -> float:
    """0 to 1; prefix weight 0.1 over at most four letters, where the Jaro similarity is above 0.7."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, hits = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                hits.append(ch)
                break
    m = len(hits)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(hits, (b[j] for j in range(len(b)) if taken[j]))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


# --- many pairs at a time ------------------------------------------------------------------------------------------

#: Cells of a diagonal that are combed at once, so that the four tables of a block stay in the cache.
CELLS = 1 << 15


def _table(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, fill: int, dtype: type) -> np.ndarray:
    """One column a text, filled up at its end."""
    at = np.arange(lengths.max())[:, None]
    return np.where(at < lengths, flat[np.minimum(starts + at, len(flat) - 1)], fill).astype(dtype)


def _combed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the strand that leaves each column of b entered: below 0 from the side, else a column of b; one pair a column of a and b.

    Strands cross once at most, and not at a match (semi-local LCS by combing): lcs(a, b[s:e]) is e - s less the strands that enter at s or later and leave
    before e. Cells of one diagonal don't depend on each other.
    """
    m, n = len(a), len(b)
    kind, flag = (np.int16, 1 << 14) if m + n < 1 << 14 else (np.int32, 1 << 30)
    a = a[::-1]
    h = np.repeat(np.arange(m, dtype=kind)[:, None], a.shape[1], axis=1)
    v = np.repeat(np.arange(m, m + n, dtype=kind)[:, None], a.shape[1], axis=1)
    for d in range(m + n - 1):
        first, last = max(0, d - n + 1), min(m - 1, d)
        rows, cols = slice(m - 1 - last, m - first), slice(d - last, d - first + 1)
        # a match swaps as if h were the larger one
        tall = (a[rows] == b[cols]).astype(kind)
        tall *= flag
        tall |= h[rows]
        np.minimum(tall, v[cols], out=h[rows])
        np.maximum(tall, v[cols], out=v[cols])
        v[cols] &= flag - 1
    return v - kind(m)


def stretch_scores(left: list[str], right: list[str], stretches: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """lcs_length of each pair, and with ``stretches`` what _best_stretch() says of the shorter against the longer (of equal ones: of left against right)."""
    short = [a if len(a) <= len(b) else b for a, b in zip(left, right)]
    long = [b if len(a) <= len(b) else a for a, b in zip(left, right)]
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (short, long)]
    flats = [np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), np.uint32) for side in (short, long)]
    starts = [np.cumsum(n) - n for n in sizes]
    lcs, best = np.zeros(len(left), np.int64), np.zeros(len(left)) if stretches else None
    dtype, end = (np.uint16, 0xFFFF) if all(f.max(initial=0) < 0xFFFE for f in flats) else (np.uint32, 2**32 - 1)
    order = np.lexsort((sizes[1], sizes[0]))
    order = order[sizes[0][order] > 0]
    while len(order):
        # a block of pairs of about the same lengths, a single one where a text is very long
        take = order[: max(1, CELLS // int(sizes[0][order[0]]))]
        widest = np.maximum.accumulate(sizes[1][take])
        take = max(1, np.count_nonzero(widest * np.arange(1, len(take) + 1) <= 8 * CELLS))
        some, order = order[:take], order[take:]
        m, n = sizes[0][some], sizes[1][some]
        came = _combed(*(_table(f, s[some], k, fill, dtype) for f, s, k, fill in zip(flats, starts, (m, n), (end, end - 1)))).T
        at = np.arange(came.shape[1])
        inside, free = at < n[:, None], came < 0
        reached = np.cumsum(free & inside, axis=1)
        lcs[some] = reached[:, -1]
        if not stretches:
            continue
        m, n = m[:, None], n[:, None]
        heads = np.where(at < m, 200.0 * reached / (m + at + 1), 0.0).max(axis=1)
        # a strand from x to r counts in the stretches that begin at r - m + 1 to x
        since, width = np.maximum(0, at - m + 1), came.shape[1] + 1
        row, col = np.nonzero(inside & ~free & (since <= came))
        opened = np.bincount(row * width + since[row, col], minlength=len(some) * width)
        closed = np.bincount(row * width + came[row, col] + 1, minlength=len(some) * width)
        lost = np.cumsum((opened - closed).reshape(len(some), width), axis=1)[:, :-1]
        size = np.minimum(at + m, n) - at
        tails = np.where(inside, 200.0 * (size - lost) / (m + np.maximum(size, 0)), 0.0).max(axis=1)
        best[some] = np.maximum(heads, tails)
    return lcs, best


def _ratios(left: list[str], right: list[str], lcs: np.ndarray) -> np.ndarray:
    total = np.fromiter((len(a) + len(b) for a, b in zip(left, right)), np.int64, len(left))
    return np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0)


def _set_ratios(left: list[str], right: list[str]) -> np.ndarray:
    words = lru_cache(1 << 14)(lambda s: frozenset(s.split()))
    out, at, one, other, least = np.zeros(len(left)), [], [], [], []
    for k, (a, b) in enumerate(zip(left, right)):
        x, y = words(a), words(b)
        if not x or not y:
            continue
        if x <= y or y <= x:
            out[k] = 100.0
            continue
        both = " ".join(sorted(x & y))
        with_x, with_y = (f"{both} {' '.join(sorted(z))}".strip() for z in (x - y, y - x))
        at.append(k)
        one.append(with_x)
        other.append(with_y)
        # the shared words begin both texts
        least.append(200.0 * len(both) / (len(both) + min(len(with_x), len(with_y))) if both else 0.0)
    if at:
        out[at] = np.maximum(_ratios(one, other, stretch_scores(one, other, False)[0]), least)
    return out


def _partial_ratios(left: list[str], right: list[str], best: np.ndarray) -> np.ndarray:
    same = [k for k, (a, b) in enumerate(zip(left, right)) if len(a) == len(b)]
    if same:
        # of equal lengths either is the shorter one
        turned = stretch_scores([right[k] for k in same], [left[k] for k in same], True)[1]
        best = best.copy()
        best[same] = np.maximum(best[same], turned)
    return np.where([not a and not b for a, b in zip(left, right)], 100.0, best)


def batch_scores(left: list[str], right: list[str], scores: tuple[str, ...]) -> dict[str, np.ndarray]:
    """The named SCORERS of all pairs, equal to theirs."""
    out = {}
    if {"ratio", "partial"} & set(scores):
        lcs, best = stretch_scores(left, right, "partial" in scores)
        out["ratio"] = _ratios(left, right, lcs)
        if best is not None:
            out["partial"] = _partial_ratios(left, right, best)
    if "tsort" in scores:
        ordered = lru_cache(1 << 14)(lambda s: " ".join(sorted(s.split())))
        a, b = (list(map(ordered, side)) for side in (left, right))
        out["tsort"] = _ratios(a, b, stretch_scores(a, b, False)[0])
    if "tset" in scores:
        out["tset"] = _set_ratios(left, right)
    if "jw" in scores:
        out["jw"] = np.fromiter(map(jaro_winkler, left, right), np.float64, len(left))
    return {s: out[s] for s in scores}


SCORERS = {"ratio": ratio, "tsort": token_sort_ratio, "tset": token_set_ratio, "partial": partial_ratio, "jw": jaro_winkler}


def string_scores(*scores: str):
    """Arrow UDF of two string columns: struct of the named scores."""

    @F.arrow_udf("struct<" + ", ".join(f"{s}:double" for s in scores) + ">")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            once: dict[tuple[str, str], int] = {}
            place = [once.setdefault((a or "", b or ""), len(once)) for a, b in zip(left.to_pylist(), right.to_pylist())]
            found = batch_scores([a for a, _ in once], [b for _, b in once], scores)
            yield pa.StructArray.from_arrays([pa.array(found[s][place], pa.float64()) for s in scores], list(scores))

    return scored


# --- native -----------------------------------------------------------------------------------------------------


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    return overlap(a, b) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def min_overlap(a: Column, b: Column) -> Column:
    """Shared distinct elements over the smaller size; sizes count repeats."""
    return overlap(a, b) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))


def tri_state(known: Column, agree: Column) -> Column:
    """1 agree, -1 conflict, 0 unknown."""
    return F.when(known, F.when(agree, F.lit(1)).otherwise(F.lit(-1))).otherwise(F.lit(0))


def contains_either(a: Column, b: Column) -> Column:
    return ((F.length(a) > 3) & (F.length(b) > 3) & (F.contains(a, b) | F.contains(b, a))).cast("int")


def relative_length_gap(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalise(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), norm))
