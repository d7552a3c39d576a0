"""Arrow kernels for cosine similarity between blocks of sparse vectors.

Spark forms, places and joins the blocks; each call here works on one row: a
block of query vectors against a block of candidate vectors, both of bounded
size. Vectors are unit length and not negative. Blocks arrive as flat arrays
(ids, entries per vector, category numbers, weights).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Similarities are compared after rounding, so that the order in which a sum was
# formed decides no tie.
DIGITS = 9
SLACK = 2e-9
GATHERED = 50_000  # candidates that a block of queries gathers before they are put in order


def _values(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    scalar = batch.column(name)[row]
    return scalar.values if scalar.is_valid else pa.array([], type=batch.column(name).type.value_type)


def _numbers(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return _values(batch, name, row).to_numpy(zero_copy_only=False)


def _matrix(batch: pa.RecordBatch, side: str, row: int, width: int) -> np.ndarray:
    sizes = _numbers(batch, f"{side}_sizes", row)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), _numbers(batch, f"{side}_cats", row)] = _numbers(
        batch, f"{side}_weights", row
    )
    return out


def kth_similarity(sims: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Per query: similarity of the k-th best owner in the block, 0 if it has fewer."""
    if sims.shape[1] == 0:
        return np.zeros(sims.shape[0])
    best = sims.shape[1] if sims.shape[1] <= k else k
    columns = np.argpartition(-sims, best - 1, axis=1)[:, :best]
    rows = np.arange(len(sims))[:, None]
    columns = columns[rows, np.argsort(-sims[rows, columns], axis=1)]
    reached = np.cumsum(copies[columns], axis=1) >= k
    first = reached.argmax(axis=1)
    found = sims[rows[:, 0], columns[rows[:, 0], first]]
    return np.where(reached.any(axis=1), found, 0.0)


def cell_bounds(queries: np.ndarray) -> np.ndarray:
    """Per query and cell c: the largest cosine with any vector whose largest entry is c.

    Such vectors form a cone. The projection of the query on it replaces entry c
    and the entries above the running mean by their mean, largest first.
    """
    n, width = queries.shape
    ordered = -np.sort(-queries, axis=1)
    depth = max(int((ordered > 0).sum(axis=1).max(initial=0)), 1)
    out = np.empty((n, width))
    for c in range(width):
        own = queries[:, c].copy()
        pooled, members = own.copy(), np.ones(n)
        squares = own**2
        # Walk the other entries from the largest down; skip the entry of c itself once.
        skipped = own <= 0
        growing = np.ones(n, dtype=bool)
        for j in range(min(depth, width)):
            value = ordered[:, j]
            is_own = growing & ~skipped & (value == own)
            skipped |= is_own
            growing &= is_own | (value > pooled / members)
            take = growing & ~is_own
            pooled = np.where(take, pooled + value, pooled)
            squares = np.where(take, squares + value**2, squares)
            members = np.where(take, members + 1, members)
        out[:, c] = np.sqrt(np.maximum(pooled**2 / members + (1.0 - squares), 0.0))
    return out


def thresholds(k: int, id_type: pa.DataType):
    """Kernel: lower bound of the k-th similarity from one block, and the cells worth a visit.

    ``cell_groups`` names the group of cells each category's cell belongs to, -1 for
    cells without candidates. Gives one row per group to visit, with the queries of the
    block that visit it, their places in the block (``q_at``) and the block's first id and size.
    """
    schema = pa.schema(
        [
            ("cell_group", pa.int32()),
            ("q_block", id_type),
            ("q_total", pa.int32()),
            ("q_at", pa.list_(pa.int32())),
            ("q_ids", pa.list_(id_type)),
            ("q_floors", pa.list_(pa.float64())),
            ("q_sizes", pa.list_(pa.int32())),
            ("q_cats", pa.list_(pa.int32())),
            ("q_weights", pa.list_(pa.float64())),
        ]
    )

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                width = batch.column("n_categories")[row].as_py()
                queries = _matrix(batch, "q", row, width)
                block = _matrix(batch, "p", row, width)
                sims = np.round(queries @ block.T, DIGITS)
                floors = kth_similarity(sims, _numbers(batch, "p_copies", row), k)
                visits = cell_bounds(queries) >= floors[:, None] - SLACK
                ids = _values(batch, "q_ids", row)
                groups = _numbers(batch, "cell_groups", row)
                out = {name: [] for name in schema.names}
                for group in np.unique(groups[groups >= 0]):
                    chosen = np.flatnonzero(visits[:, groups == group].any(axis=1))
                    if not len(chosen):
                        continue
                    part = queries[chosen]
                    at_row, at_cat = np.nonzero(part)
                    out["cell_group"].append(int(group))
                    out["q_block"].append(ids[0].as_py())
                    out["q_total"].append(len(queries))
                    out["q_at"].append(chosen.astype(np.int32))
                    out["q_ids"].append(ids.take(pa.array(chosen)))
                    out["q_floors"].append(floors[chosen])
                    out["q_sizes"].append(np.bincount(at_row, minlength=len(chosen)).astype(np.int32))
                    out["q_cats"].append(at_cat.astype(np.int32))
                    out["q_weights"].append(part[at_row, at_cat])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in schema], schema=schema
                )

    return run


class _Best:
    """The best k candidates so far of every query of one block.

    What blocks offer is gathered and put in order once it is worth it. ``floors`` and ``last`` are the similarity
    and the name of a query's k-th candidate; ``full`` says that there is one.
    """

    def __init__(self, n: int, query_type: pa.DataType, k: int):
        self.k, self.query_type = k, query_type
        self.ids: list = [None] * n
        self.floors, self.full = np.zeros(n), np.zeros(n, dtype=bool)
        self.known = np.zeros(n, dtype=bool)
        self.last: np.ndarray | None = None
        self.rows, self.sims = np.empty(0, dtype=np.int64), np.empty(0)
        self.owners: np.ndarray | None = None
        self.offered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def ask(self, at: np.ndarray, ids: list, floors: np.ndarray) -> None:
        """Queries at the places ``at`` take part from now on, if they did not before."""
        for place, name in zip(at.tolist(), ids, strict=True):
            self.ids[place] = name
        new = at[~self.known[at]]
        self.floors[new] = floors[~self.known[at]]
        self.known[at] = True

    def meet(self, at: np.ndarray, queries: np.ndarray, owners: np.ndarray, block: np.ndarray) -> None:
        sims = queries @ block.T
        least = np.maximum(self.floors[at] - SLACK, np.finfo(float).tiny)
        rows, columns = np.nonzero(sims >= least[:, None])
        found, rows, names = np.round(sims[rows, columns], DIGITS), at[rows], owners[columns]
        floors = self.floors[rows]
        wanted = (found >= floors) & (found > 0)
        if self.last is not None:
            wanted &= (found > floors) | ~self.full[rows] | (names < self.last[rows])
        if wanted.any():
            self.offered.append((rows[wanted], found[wanted], names[wanted]))
        if sum(len(o[0]) for o in self.offered) > max(GATHERED, len(self.rows) // 2):
            self.settle()

    def settle(self) -> None:
        if not self.offered:
            return
        parts = [*self.offered, *([] if self.owners is None else [(self.rows, self.sims, self.owners)])]
        rows, found, names = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((names, -found, rows))
        rows, found, names = rows[order], found[order], names[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        at_k = place == self.k - 1
        if self.last is None or self.last.dtype != names.dtype:
            self.last = np.zeros(len(self.floors), names.dtype) if self.last is None else self.last.astype(names.dtype)
        self.floors[rows[at_k]] = np.maximum(self.floors[rows[at_k]], found[at_k])
        self.last[rows[at_k]] = names[at_k]
        self.full[rows[at_k]] = True
        keep = place < self.k
        self.rows, self.sims, self.owners, self.offered = rows[keep], found[keep], names[keep], []

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        self.settle()
        owner_type = schema.field("profile_id").type
        owners = [] if self.owners is None else self.owners.tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids, type=self.query_type).take(pa.array(self.rows)),
                pa.array(owners, type=owner_type),
                pa.array(self.sims),
            ],
            schema=schema,
        )


def best_of_blocks(k: int, query_type: pa.DataType, owner_type: pa.DataType):
    """Kernel: per query the best k candidates at or above its floor.

    Rows with the same block of queries follow each other, those of one group of cells
    together. Only one such block is held at a time, and its floors rise as candidate blocks pass.
    """
    schema = pa.schema([("query_id", query_type), ("profile_id", owner_type), ("similarity", pa.float64())])

    def run(batches):
        current, visit, best = None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                width = batch.column("n_categories")[row].as_py()
                key = batch.column("q_block")[row].as_py()
                if best is None or key != current:
                    if best is not None:
                        yield best.batch(schema)
                    current, visit = key, None
                    best = _Best(batch.column("q_total")[row].as_py(), query_type, k)
                group = batch.column("cell_group")[row].as_py()
                if group != visit:
                    visit = group
                    at, queries = _numbers(batch, "q_at", row).astype(np.int64), _matrix(batch, "q", row, width)
                    best.ask(at, _values(batch, "q_ids", row).to_pylist(), _numbers(batch, "q_floors", row))
                owners = _values(batch, "p_ids", row)
                names = np.array(owners.to_pylist(), dtype=str) if pa.types.is_string(owner_type) else owners.to_numpy()
                best.meet(at, queries, names, _matrix(batch, "p", row, width))
        if best is not None:
            yield best.batch(schema)

    return run
