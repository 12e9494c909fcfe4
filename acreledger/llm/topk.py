"""Exact top-k search by inner product over an impact-ordered index, a score at a time.

The vectors of a block are indexed by component.  A component's values fall into levels; the rows of one level
of one component are a posting segment, which knows its least and greatest value.  For a query, a segment's
impact is what it can add above the least that its component gives to any row.  Segments are
processed by descending impact, whatever their component, and add their impact to their rows' sums.  At any time a row
can reach at most its sum and, for each component it has not been seen in, the impact of that component's next
segment.  Rows that cannot reach the k-th best exact score found so far are out; when few are left, or no segment is,
those left are rescored exactly.  Nothing is dropped without this proof, so results are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import BLOCK, PART, first_k, in_blocks, keys_of, matrix, nullable, prepared, ranked

#: Levels of a component's values, and looks at the bounds during a search.
LEVELS, LOOKS = 64, 8


class ImpactIndex:
    """Posting segments of the whole-number vectors of one block."""

    def __init__(self, rows: np.ndarray, levels: int = LEVELS):
        self.exact = rows.astype(np.float64)
        n, dim = rows.shape
        low = rows.min(axis=0)
        width = rows.max(axis=0).astype(np.int64) - low + 1
        level = (rows - low).astype(np.int64) * levels // width
        postings, sizes, least, most, component = [], [], [], [], []
        for d in range(dim):
            order = np.argsort(level[:, d], kind="stable")
            begin = np.flatnonzero(np.diff(level[order, d], prepend=-1))
            values = rows[order, d]
            postings.append(order)
            sizes.append(np.diff(np.append(begin, n)))
            least.append(np.minimum.reduceat(values, begin))
            most.append(np.maximum.reduceat(values, begin))
            component.append(np.full(len(begin), d))
        self.postings = np.concatenate(postings).astype(np.int32)
        self.sizes, self.component = np.concatenate(sizes), np.concatenate(component)
        self.least, self.most = np.concatenate(least).astype(np.float64), np.concatenate(most).astype(np.float64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.firsts = np.flatnonzero(np.diff(self.component, prepend=-1))

    def search(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Places (ties in order of place) and scores of the best ``k`` rows other than ``own``, and postings processed."""
        n, dim = self.exact.shape
        q = query.astype(np.float64)
        ends = q[self.component] * self.least, q[self.component] * self.most
        floor = np.minimum.reduceat(np.minimum(*ends), self.firsts)
        impact = np.maximum(*ends) - floor[self.component]
        order = np.argsort(-impact, kind="stable")
        done = np.cumsum(self.sizes[order])
        sums, seen = np.full(n, floor.sum()), np.zeros(n, dtype=np.int64)
        best, bound, used, upto = {}, -np.inf, 0, 0
        possible = np.arange(n)
        for look in range(1, LOOKS + 1):
            stop = int(np.searchsorted(done, done[-1] * look // LOOKS, side="left")) + 1
            some = order[upto:stop]
            if len(some):
                at = np.concatenate([self.postings[a : a + m] for a, m in zip(self.begins[some].tolist(), self.sizes[some].tolist(), strict=True)])
                sums += np.bincount(at, weights=np.repeat(impact[some], self.sizes[some]), minlength=n)
                seen += np.bincount(at, minlength=n)
                used, upto = used + len(at), stop
            following = np.zeros(dim)
            np.maximum.at(following, self.component[order[upto:]], impact[order[upto:]])
            rest = np.concatenate([[0.0], np.cumsum(-np.sort(-following))])
            reach = sums + rest[dim - seen]
            for i in possible[first_k(reach[possible], k + 1)].tolist():
                if i != own and i not in best:
                    best[i] = float(self.exact[i] @ q)
            if len(best) >= k:
                bound = sorted(best.values())[-k]
            possible = np.flatnonzero(reach >= bound)
            if len(possible) <= 2 * k + n // 16:
                break
        possible = possible[possible != own]
        scores = self.exact[possible] @ q
        chosen = first_k(scores, k)
        return possible[chosen], scores[chosen].astype(np.int64), used


def search_block(rows: pa.Table, queries: pa.Table, k: int) -> dict[str, list]:
    """The best ``k`` rows of a block for each query."""
    found: dict[str, list] = {"rid": [], "key": [], "other": [], "score": []}
    if rows.num_rows and queries.num_rows:
        dim = queries["dim"][0].as_py()
        keys, rids = keys_of(rows), rows["rid"].to_numpy()
        order = np.lexsort((rids, keys))
        keys, rids = keys[order], rids[order]
        place = {int(r): i for i, r in enumerate(rids)}
        vectors = matrix(rows, dim)[order] if dim else np.zeros((len(order), 1), dtype=np.int32)
        asked = matrix(queries, dim) if dim else np.zeros((queries.num_rows, 1), dtype=np.int32)
        index = ImpactIndex(vectors)
        for rid, key, vector in zip(queries["rid"].to_pylist(), queries["key"].to_pylist(), asked, strict=True):
            places, scores, _ = index.search(vector, k, place.get(rid, -1))
            found["rid"] += [rid] * len(places)
            found["key"] += [key] * len(places)
            found["other"] += keys[places].tolist()
            found["score"] += scores.tolist()
    return found


def top_k(df: DataFrame, is_query, key: str = "vec_id", vec: str = "embedding", factor: int = 256, k: int = 5, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds, the ``k`` other rows of highest score.

    A score is the inner product of the components ``floor(factor * x)``; ties go to the smaller key, a null key
    is last.  Vectors that are null or hold a null or non-finite component take no part; vectors of different lengths
    have no score.  Equal rows are rows of their own: each is found, and each asks.  Other input columns do not matter.
    An empty input gives no rows.
    """
    rows, _ = prepared(df, key, vec, factor, asks=F.coalesce(is_query, F.lit(False)))

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        found = search_block(left, right, k)
        other = nullable(np.array(found["other"], dtype=np.int64))
        kinds = [pa.array(found[c], pa.int64()) for c in ("rid", "key")]
        return pa.table([*kinds, other, pa.array(found["score"], pa.int64())], names=["rid", "query_id", "vec_id", "score"])

    queries = rows.where("asks").drop("asks")
    found = in_blocks(rows.drop("asks"), queries, task, "rid long, query_id long, vec_id long, score long", block, part)
    return ranked(found, ["rid"], "score", "vec_id", k).select("query_id", "rank", "vec_id", "score")
