"""Exact nearest neighbours of sparse vectors of positive weights: one block of queries against one block of targets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Sums of the same products in another order, and the rounding to nine digits, differ by less; ties are looked for within it.
SLACK = 1e-8
FOUND = "query string, ord long, cosine double"


def _sparse(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The starts of a column's lists and the end of the last, and their values."""
    lists = pa.concat_arrays(column.chunks)
    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.intp), lists.flatten()


def best(sums: np.ndarray, take: int) -> np.ndarray:
    """The places of positive sums that reach the take-th best less SLACK, all of them if there are no more than `take`."""
    groups = 8 * take
    if len(sums) >= 2 * groups:
        # `take` of the groups' largest sums reach their take-th: no sum below it is among the best.
        tops = sums[: len(sums) // groups * groups].reshape(groups, -1).max(axis=1)
        some = np.flatnonzero(sums >= np.partition(tops, -take)[-take])
        least = np.partition(sums[some], -take)[-take]
    else:
        least = np.partition(sums, -take)[-take] if len(sums) >= take else 0.0
    return np.flatnonzero((sums >= least - SLACK) & (sums > 0))


def nearest_in_block(take: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(query, keys, weights) and (ords, keys, weights) to FOUND: of each query the `take` ords of the highest sums of products.

    Every posting of every key of a query is summed. Ties, after rounding to nine digits, go by ord; `ords` are the first rows, in order,
    of those that have the same vector.
    """

    def run(queries: pa.Table, targets: pa.Table) -> pa.Table:
        names, ords, cosines = [], [], []
        if len(queries) and len(targets):
            starts, keys = _sparse(targets.column("keys"))
            coded = pc.dictionary_encode(keys)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            begins = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))]).tolist()
            posted = np.repeat(np.arange(len(targets), dtype=np.intp), np.diff(starts))[order]
            weights = _sparse(targets.column("weights"))[1].to_numpy()[order]
            del codes, order, keys
            places, asked = _sparse(queries.column("keys"))
            found = pc.fill_null(pc.index_in(asked, value_set=coded.dictionary), -1).to_numpy(zero_copy_only=False).tolist()
            wanted = _sparse(queries.column("weights"))[1].to_numpy().tolist()
            at, members = _sparse(targets.column("ords"))
            members = members.to_numpy(zero_copy_only=False)
            for k, name in enumerate(queries.column("query").to_pylist()):
                parts = [(slice(begins[c], begins[c + 1]), w) for c, w in zip(found[places[k] : places[k + 1]], wanted[places[k] : places[k + 1]], strict=True) if c >= 0]
                if not parts:
                    continue
                sums = np.bincount(np.concatenate([posted[s] for s, _ in parts]), np.concatenate([weights[s] * w for s, w in parts]), minlength=len(targets))
                near = best(sums, take)
                # The first of each vector decide which vectors come in, then all of theirs are put in order.
                rounded = np.round(sums[near], 9)
                near = near[np.lexsort((members[at[near]], -rounded))[:take]]
                rows = np.concatenate([members[at[i] : at[i + 1]] for i in near])
                value = np.repeat(sums[near], at[near + 1] - at[near])
                first = np.lexsort((rows, -np.round(value, 9)))[:take]
                names += [name] * len(first)
                ords.append(rows[first])
                cosines.append(value[first])
        columns = [pa.array(names, pa.string()), *(pa.array(np.concatenate(x) if x else [], kind) for x, kind in ((ords, pa.int64()), (cosines, pa.float64())))]
        return pa.table(columns, names=["query", "ord", "cosine"])

    return run
