"""Many logistic models over the same rows, fitted by one distributed optimisation.

A repeated cross-validation or a learning curve fits the same model again and
again on overlapping subsets of the same rows. Here every row carries its role
in each model (a byte), the parameters of a block of models are the columns of
one matrix, and each pass over the cached rows yields the loss and gradient of
all of them: per task the columns share one sparse product, the partial
gradients are added up by feature range, and only sums reach the driver. The
optimiser (L-BFGS, with orthant steps where there is an L1 penalty) then moves
every column by itself; columns that have converged leave the passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Role of a row in a model.
NONE, TRAIN, VALID = 0, 1, 2
#: Parameters (features x models) that are optimised together; more models make more blocks.
BLOCK_CELLS = 1 << 21
#: Entries x models multiplied at a time (bounds a task's memory).
STEP_CELLS = 1 << 22
#: Entries x models that a task of a pass multiplies, about.
TASK_CELLS = 1 << 20
#: Entries x models that a task multiplies for each number of its partial gradient, where partial gradients are shuffled.
TASK_SHARE = 64
#: Entries of a block of rows.
BLOCK_ENTRIES = 1 << 18
#: Numbers of partial gradients that may reach the driver in one pass; more are added up by tasks first.
PARTIAL_CELLS = 1 << 21
#: Features whose partial gradients travel in one row.
FEATURE_RANGE = 1 << 13
HISTORY = 7


def sparse_arrays(batch: pa.RecordBatch, indices: str = "indices", values: str = "values") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each row and the end, feature of each entry, value of each entry) of list columns; zeros are left out."""
    idx, val = batch.column(batch.schema.get_field_index(indices)), batch.column(batch.schema.get_field_index(values))
    start = idx.offsets.to_numpy().astype(np.int64)
    flat = idx.values.to_numpy(zero_copy_only=False)[start[0]:start[-1]]
    v0, v1 = val.offsets[0].as_py(), val.offsets[-1].as_py()
    return without_zeros(start - start[0], flat.astype(np.int64), val.values.to_numpy(zero_copy_only=False)[v0:v1].astype(float))


def without_zeros(start: np.ndarray, idx: np.ndarray, val: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    there = val != 0
    if there.all():
        return start, idx, val
    return np.concatenate([[0], np.cumsum(there)])[start], idx[there], val[there]


def fixed_arrays(batch: pa.RecordBatch, name: str, width: int, dtype) -> np.ndarray:
    """A list column of ``width`` numbers a row as a matrix."""
    col = batch.column(batch.schema.get_field_index(name))
    lo, hi = col.offsets[0].as_py(), col.offsets[-1].as_py()
    return col.values.to_numpy(zero_copy_only=False)[lo:hi].reshape(-1, width).astype(dtype)


def row_slices(batch: pa.RecordBatch, cells: int, indices: str = "indices") -> Iterator[pa.RecordBatch]:
    """Slices of about ``cells`` entries of the list column, one row at least."""
    start = batch.column(batch.schema.get_field_index(indices)).offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(start, start[at] + cells, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def margins(start: np.ndarray, idx: np.ndarray, val: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Rows x models: sparse rows times ``theta`` (features, then the bias)."""
    z = np.repeat(theta[-1:], len(start) - 1, axis=0)
    filled = np.nonzero(np.diff(start))[0]
    if len(filled):
        z[filled] += np.add.reduceat(val[:, None] * theta[idx], start[filled], axis=0)
    return z


def _packed(b: pa.RecordBatch, n_roles: int) -> dict[str, np.ndarray]:
    """The arrays of a block of rows, its entries also in feature order, so that a pass sorts nothing."""
    start, idx, val = sparse_arrays(b)
    order = np.argsort(idx, kind="stable")
    feature, first = np.unique(idx[order], return_index=True)
    return {"start": start, "idx": idx.astype(np.int32), "val": val, "row": np.repeat(np.arange(len(start) - 1), np.diff(start))[order].astype(np.int32),
            "sorted": val[order], "feature": feature.astype(np.int32), "first": first,
            "label": b.column(b.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(float),
            "role": fixed_arrays(b, "role", n_roles, np.int8).ravel()}


#: Arrays of a block and their types.
PACKED = {"start": np.int64, "idx": np.int32, "val": np.float64, "row": np.int32, "sorted": np.float64, "feature": np.int32, "first": np.int64,
          "label": np.float64, "role": np.int8}


def pack_rows(rows: DataFrame, n_roles: int) -> DataFrame:
    """(label, indices, values, role) -> blocks of about BLOCK_ENTRIES entries, one binary column an array; narrow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in row_slices(big, BLOCK_ENTRIES):
                block = _packed(b, n_roles)
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(block[n], t).tobytes()], pa.binary()) for n, t in PACKED.items()], list(PACKED))

    return rows.select("label", "indices", "values", "role").mapInArrow(run, ", ".join(f"{n} binary" for n in PACKED))


def _loss_and_gradient(block: dict[str, np.ndarray], w: np.ndarray, theta: np.ndarray, grad: np.ndarray) -> np.ndarray:
    z = margins(block["start"], block["idx"], block["val"], theta)
    y = block["label"][:, None]
    g = w * (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y)
    if len(block["row"]):
        grad[block["feature"]] += np.add.reduceat(block["sorted"][:, None] * g[block["row"]], block["first"], axis=0)
    grad[-1] += g.sum(0)
    return (w * np.logaddexp(0, np.where(y > 0, -z, z))).sum(0)


def _positives_and_curvature(block: dict[str, np.ndarray], w: np.ndarray, theta: np.ndarray, grad: np.ndarray) -> np.ndarray:
    if len(block["row"]):
        grad[block["feature"]] += np.add.reduceat((block["sorted"] ** 2 / 4)[:, None] * w[block["row"]], block["first"], axis=0)
    grad[-1] += w.sum(0) / 4
    return (w * block["label"][:, None]).sum(0)


def training_weights(label: np.ndarray, role: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weight of every row in every model: zero outside its training rows, ``positive`` (a model) for label 1, else 1."""
    return np.where(label[:, None] > 0, positive[None, :], 1.0) * (role == TRAIN)


class Passes:
    """Loss, gradient and weight sum of columns of models over the cached blocks of ``pack_rows``."""

    def __init__(self, blocks: DataFrame, roles: np.ndarray, n_roles: int, positive: np.ndarray):
        self.blocks, self.spark, self.parts = blocks, blocks.sparkSession, blocks.rdd.getNumPartitions()
        self.roles, self.n_roles, self.positive = roles, n_roles, positive

    def curvature(self, size: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weighted positives a column, a bound of the loss's second derivatives by each parameter, and the weight sum a column."""
        return self(np.zeros((size, len(columns))), columns, _positives_and_curvature)

    def __call__(self, theta: np.ndarray, columns: np.ndarray, add_up=_loss_and_gradient) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``theta``: (features + 1, len(columns)) -> loss and weight sum a column, gradient."""
        shared = self.spark.sparkContext.broadcast((theta, self.roles[columns], self.positive[columns]))
        n_roles, width = self.n_roles, len(columns)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            theta, roles, positive = shared.value
            grad, sums = np.zeros_like(theta), np.zeros((2, width))
            for b in batches:
                for i in range(b.num_rows):
                    block = {n: np.frombuffer(b.column(c)[i].as_buffer(), t) for c, (n, t) in enumerate(PACKED.items())}
                    w = training_weights(block["label"], block["role"].reshape(-1, n_roles)[:, roles], positive)
                    sums[0] += add_up(block, w, theta, grad)
                    sums[1] += w.sum(0)
            ranges, out = [-1], [sums.tobytes()]
            for at in range(0, len(grad), FEATURE_RANGE):
                piece = grad[at:at + FEATURE_RANGE]
                if piece.any():
                    ranges.append(at)
                    out.append(np.ascontiguousarray(piece).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(out, pa.binary())], ["at", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, total = None, None
            for b in batches:
                for now, piece in zip(b.column(0).to_pylist(), b.column(1)):
                    if now != at:
                        if at is not None:
                            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["at", "sums"])
                        at, total = now, 0.0
                    total = total + np.frombuffer(piece.as_buffer())
            if at is not None:
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["at", "sums"])

        schema = "at int, sums binary"
        got = self.blocks.mapInArrow(part, schema)
        if self.parts * theta.size > PARTIAL_CELLS:  # added up by feature range before they reach the driver
            got = got.repartition("at").sortWithinPartitions("at").mapInArrow(add, schema)
        grad, sums = np.zeros_like(theta), np.zeros((2, width))
        for at, piece in zip(*got.toArrow().to_pydict().values()):
            values = np.frombuffer(piece).reshape(-1, width)
            if at < 0:
                sums = sums + values
            else:
                grad[at:at + len(values)] += values
        shared.unpersist()
        return sums[0], grad, sums[1]


def minimise(evaluate, curvature: np.ndarray, bias: np.ndarray, l2: np.ndarray, l1: np.ndarray, average: bool, max_iter: np.ndarray,
             tol: float) -> np.ndarray:
    """Columns of parameters (the last row is the bias, without penalty) that minimise loss + l2/2 |t|^2 + l1 |t|.

    ``evaluate(theta, columns)`` gives loss, gradient and weight sum of the
    given columns; ``average`` divides by the weight sum. Every column follows
    its own L-BFGS with backtracking, from ``bias`` and zeros, each parameter
    scaled by the bound of its ``curvature``; all trial points of a round are
    one pass.
    """
    size, columns = curvature.shape
    penalised = np.ones((size, 1))
    penalised[-1] = 0

    def smooth(t, at):
        f, g, n = evaluate(t, at)
        scale = 1.0 / np.maximum(n, 1e-300) if average else np.ones(len(at))
        return f * scale + l2[at] / 2 * (penalised * t * t).sum(0), g * scale + l2[at] * penalised * t

    def pseudo(t, g, at):
        pen = l1[at] * penalised
        right, left = g + pen, g - pen
        at_zero = np.where(right < 0, right, np.where(left > 0, left, 0.0))
        return np.where(t > 0, right, np.where(t < 0, left, at_zero))

    def whole(f, t, at):
        return f + (l1[at] * penalised * np.abs(t)).sum(0)

    theta, every = np.zeros((size, columns)), np.arange(columns)
    theta[-1] = bias
    f, g, n = evaluate(theta, every)
    scale = 1.0 / np.maximum(n, 1e-300) if average else np.ones(columns)
    f, g = f * scale, g * scale  # all penalised parameters are zero
    inverse = 1.0 / np.maximum(curvature * scale + l2 * penalised, 1e-12)
    f = whole(f, theta, every)
    pg = pseudo(theta, g, every)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    gamma = np.ones(columns)
    open_ = np.nonzero(np.abs(pg).max(0) > 1e-12)[0]
    done = 0
    while len(open_ := open_[max_iter[open_] > done]):
        done += 1
        q, alphas = pg[:, open_].copy(), []
        for s, d, rho in reversed(steps):
            alphas.append(rho[open_] * (s[:, open_] * q).sum(0))
            q -= alphas[-1] * d[:, open_]
        q *= gamma[open_] * inverse[:, open_]
        for (s, d, rho), a in zip(steps, reversed(alphas)):
            q += s[:, open_] * (a - rho[open_] * (d[:, open_] * q).sum(0))
        move = -q
        move[move * pg[:, open_] > 0] = 0.0 if l1[open_].any() else move[move * pg[:, open_] > 0]
        uphill = (move * pg[:, open_]).sum(0) >= 0
        move[:, uphill] = -pg[:, open_[uphill]] * inverse[:, open_[uphill]]
        orthant = np.where(theta[:, open_] != 0, np.sign(theta[:, open_]), -np.sign(pg[:, open_]))
        bound = (l1[open_] > 0) * penalised > 0

        new, f2, g2 = theta[:, open_].copy(), f[open_].copy(), g[:, open_].copy()
        waiting, rate, settled = np.arange(len(open_)), np.ones(len(open_)), np.zeros(len(open_), bool)
        for _ in range(30):
            t = theta[:, open_[waiting]] + rate[waiting] * move[:, waiting]
            t = np.where(bound[:, waiting] & (np.sign(t) != orthant[:, waiting]), 0.0, t)
            value, slope = smooth(t, open_[waiting])
            value = whole(value, t, open_[waiting])
            down = (pg[:, open_[waiting]] * (t - theta[:, open_[waiting]])).sum(0)
            good = value <= f[open_[waiting]] + 1e-4 * down
            hit = waiting[good]
            new[:, hit], f2[hit], g2[:, hit], settled[hit] = t[:, good], value[good], slope[:, good], True
            rise = (value - f[open_[waiting]] - down)[~good]
            waiting = waiting[~good]
            rate[waiting] *= np.clip(-down[~good] / np.maximum(2 * rise, 1e-300), 0.05, 0.5)  # the parabola through what is known
            if not len(waiting):
                break
        s, d = np.zeros_like(theta), np.zeros_like(theta)
        s[:, open_], d[:, open_] = new - theta[:, open_], g2 - g[:, open_]
        sy = (s * d).sum(0)
        useful = sy > 1e-14
        steps = [*steps[-(HISTORY - 1):], (s, d, np.where(useful, 1.0 / np.where(useful, sy, 1.0), 0.0))]
        yy = (d * d * inverse).sum(0)
        gamma = np.where(useful, sy / np.where(useful, yy, 1.0), gamma)
        gained = f[open_] - f2
        theta[:, open_], f[open_], g[:, open_] = new, f2, g2
        pg[:, open_] = pseudo(new, g2, open_)
        ends = ~settled | (gained <= tol * np.maximum(np.abs(f2), 1e-8)) | (np.abs(pg[:, open_]).max(0) <= 1e-12)
        open_ = open_[~ends]
    return theta


def pass_tasks(entries: int, size: int, width: int, cores: int) -> int:
    """Tasks of a pass over ``entries`` entries for ``width`` models of ``size`` parameters.

    Their work asks for their number, but every task sends a whole partial gradient: where these
    are too many for the driver, tasks beyond the cores must multiply TASK_SHARE times what they send.
    """
    cells, sent = entries * width, size * width
    tasks = max(1, -(-cells // TASK_CELLS))
    return tasks if tasks * sent <= PARTIAL_CELLS else min(tasks, max(cores, cells // (TASK_SHARE * sent)))


def per_model(value, n_models: int) -> np.ndarray:
    return np.broadcast_to(np.asarray(value, float), (n_models,)).copy()


def fit_logistic_many(rows: DataFrame, n_features: int, n_roles: int, positive=1.0, l2=0.0, l1=0.0, average: bool = True,
                      max_iter=100, tol: float = 1e-9, roles: Sequence[int] | None = None, block_cells: int = BLOCK_CELLS) -> np.ndarray:
    """(features + 1, models) parameters of many logistic models over ``rows``.

    ``rows``: (label, indices, values, role); ``role`` has ``n_roles`` bytes. A
    model trains on the rows whose role number ``roles[model]`` is TRAIN;
    default is one model for each role. ``positive``, ``l2``, ``l1`` and
    ``max_iter`` hold for all models or give one value each. The rows are read
    once, into cached blocks that every pass reads. Memory of the driver and of
    a task follows ``block_cells``, not the rows; a model without training rows
    keeps zero parameters.
    """
    roles = np.arange(n_roles) if roles is None else np.asarray(roles, int)
    n_models = len(roles)
    positive, l2, l1, max_iter = (per_model(v, n_models) for v in (positive, l2, l1, max_iter))
    out = np.zeros((n_features + 1, n_models))
    width = max(1, block_cells // (n_features + 1))
    # a pass is as many tasks as its work asks for, not as many as the rows happen to have partitions
    entries = rows.agg(F.sum(F.size("indices"))).first()[0] or 0
    tasks = pass_tasks(entries, n_features + 1, min(width, n_models), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = pack_rows(rows.coalesce(tasks), n_roles).persist(StorageLevel.MEMORY_AND_DISK)
    for at in range(0, n_models, width):
        block = np.arange(at, min(n_models, at + width))
        passes = Passes(blocks, roles[block], n_roles, positive[block])
        positives, curvature, weight = passes.curvature(n_features + 1, np.arange(len(block)))
        share = np.clip(positives / np.maximum(weight, 1e-300), 1e-6, 1 - 1e-6)
        bias = np.where(weight > 0, np.log(share / (1 - share)), 0.0)
        out[:, block] = minimise(passes, curvature, bias, l2[block], l1[block], average, max_iter[block], tol)
    blocks.unpersist()
    return out


def score_many(rows: DataFrame, theta: np.ndarray, n_roles: int, roles: Sequence[int] | None = None, splits: Sequence[int] = (TRAIN, VALID),
               block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(model, split, doc_id, label, score) of every row under the models in which its role is one of ``splits``; narrow."""
    roles = np.arange(n_roles) if roles is None else np.asarray(roles, int)
    width, out = max(1, block_cells // len(theta)), None
    for at in range(0, len(roles), width):
        shared = rows.sparkSession.sparkContext.broadcast((theta[:, at:at + width], roles[at:at + width]))
        block = _score_block(rows, shared, at, n_roles, tuple(splits))
        out = block if out is None else out.unionByName(block)
    return out


def _score_block(rows: DataFrame, shared, first: int, n_roles: int, splits: tuple[int, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta, roles = shared.value
        for big in batches:
            for b in row_slices(big, max(1, STEP_CELLS // theta.shape[1])):
                z = margins(*sparse_arrays(b), theta)
                yield from scored_rows(b, z, roles, first + np.arange(len(roles)), n_roles, splits)

    return rows.select("doc_id", "label", "indices", "values", "role").mapInArrow(run, scored_schema(rows))


def scored_schema(rows: DataFrame) -> str:
    return f"model int, split string, doc_id {rows.schema['doc_id'].dataType.simpleString()}, label int, score double"


def scored_rows(b: pa.RecordBatch, z: np.ndarray, roles: np.ndarray, models: np.ndarray, n_roles: int, splits: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """A row for each column of ``z`` (numbered by ``models``) and batch row whose role number ``roles`` is one of ``splits``."""
    role = fixed_arrays(b, "role", n_roles, np.int8)[:, roles]
    names = np.array(["none", "train", "valid"])
    for at in range(0, len(z), 1 << 10):
        row, model = np.nonzero(np.isin(role[at:at + (1 << 10)], splits))
        row += at
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(models[model].astype(np.int32)), pa.array(names[role[row, model]].tolist(), pa.string()), b.column(0).take(take),
             b.column(1).take(take).cast(pa.int32()), pa.array(z[row, model])], ["model", "split", "doc_id", "label", "score"])


def sparse_columns(features: str = "features") -> tuple:
    """``indices`` and ``values`` of a vector column; dense vectors are read as sparse."""
    v = F.unwrap_udt(features)
    dense = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(v["indices"], dense).alias("indices"), v["values"].alias("values")


def sparse_rows(features: DataFrame, roles: DataFrame) -> DataFrame:
    """(doc_id, features) and (doc_id, label, role) -> (doc_id, label DOUBLE, indices, values, role)."""
    return features.select("doc_id", *sparse_columns()).join(
        roles.select("doc_id", F.col("label").cast("double").alias("label"), F.col("role").cast("array<tinyint>").alias("role")), "doc_id")


def n_features(features: DataFrame) -> int:
    """Length of the vectors (0 without rows)."""
    v = F.unwrap_udt("features")
    return int(features.select(F.max(F.coalesce(v["size"], F.size(v["values"]))).alias("n")).first()["n"] or 0)
