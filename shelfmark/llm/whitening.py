"""Embedding whitening: leading components of the covariance by Jacobi-Davidson.

Vectors become integers, floor(``SCALE`` * c) + ``SHIFT``; the fit list holds every distinct one once, in blocks written to the shared folder. Covariances
are never formed: a product with the covariance is one distributed pass that centres exactly (n * x - S is an integer, S the sums per
dimension), multiplies, and adds up per task and per group of tasks, always in the same order, so that a repeated task gives the same bits.

The solver works on all wanted components at once. Each turn it projects the covariance on the search space (Rayleigh-Ritz), locks components whose
residual is down to double precision, solves the projected correction equations of the others by MINRES, in step, so that one pass serves them all,
and adds the corrections to the search space, which starts anew from the best Ritz vectors when it is full. Only the search space (dimensions times a
few dozen) and sums of the same size are ever on the driver.

Defined results: rows whose vector is null or empty, holds null or non-finite entries, or entries of 2^40 or more in magnitude, are dropped; so are
vectors whose length isn't the most common one (ties: the longest). Repeated rows and ids each get their rows; a null id stays null. Directions whose
variance is zero, to double precision, have no component, so a single distinct vector or an empty table gives no rows. ``deviation`` is null
where it does not fit a long. Other columns are ignored. A component's sign makes its largest entry positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
BLOCK_ENTRIES = 1 << 19  # of a block of the fit list, whatever the length of its vectors
FAN_IN = 32
HALF = 24  # bits of the lower half of an entry, summed apart from the upper one
MINRES_STEPS, MOST_TURNS = 8, 300
SEED = 11
EPS = float(np.finfo(np.float64).eps)


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, x`` of the usable rows; ``x`` holds little-endian 64-bit integers."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2**40))
    rows = own.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", fine))

    def work(batches):
        for batch in batches:
            xs = [(np.floor(v.values.to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + SHIFT) for v in batch["vector"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([len(x) for x in xs], pa.int32()), pa.array([x.astype("<i8").tobytes() for x in xs], pa.binary())], ["id", "dim", "x"]
            )

    return rows.mapInArrow(work, f"id {own.schema['id'].dataType.simpleString()}, dim int, x binary")


def fit_blocks(rows: DataFrame, dim: int) -> DataFrame:
    """``n, data``: the distinct vectors, a block at a time."""
    size = max(BLOCK_ENTRIES // dim, 1)

    def work(batches):
        held: list[bytes] = []
        for batch in batches:
            held += batch["x"].to_pylist()
            while len(held) >= size:
                yield pa.RecordBatch.from_pydict({"n": pa.array([size], pa.int64()), "data": pa.array([b"".join(held[:size])], pa.binary())})
                held = held[size:]
        if held:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(held)], pa.int64()), "data": pa.array([b"".join(held)], pa.binary())})

    return rows.select("x").distinct().mapInArrow(work, "n bigint, data binary")


class FitList:
    """The fit list as it lies in the shared folder, and passes over it. Sums are Python integers, as they may exceed 64 bits."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim = blocks, dim
        self.n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.tasks = blocks.rdd.getNumPartitions()

        def halves(x):
            return np.concatenate([(x >> HALF).sum(axis=0), (x & ((1 << HALF) - 1)).sum(axis=0)])

        high, low = self.total(halves, 2 * dim, np.int64).reshape(2, dim)
        self.sums = [(int(h) << HALF) + int(m) for h, m in zip(high, low, strict=True)]
        # The mean as a whole part and a rest, so that centring loses nothing.
        self.whole = np.array([s // max(self.n, 1) for s in self.sums], np.int64)
        self.rest = np.array([s % max(self.n, 1) for s in self.sums], np.int64)

    def centred(self):
        """Function from integers to their distance from the mean."""
        whole, part = self.whole, self.rest / max(self.n, 1)
        return lambda x: (x - whole) - part

    def total(self, of_block, size: int, kind=np.float64) -> np.ndarray:
        """Sum of ``of_block`` (``size`` numbers) over the blocks' integers: per task, then per ``FAN_IN`` tasks, then here; always in order."""
        dim = self.dim

        def per_task(batches):
            part, held = TaskContext.get().partitionId(), np.zeros(size, kind)
            for batch in batches:
                for data in batch["data"]:
                    held = held + of_block(np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dim)).reshape(size)
            yield pa.RecordBatch.from_arrays([pa.array([part // FAN_IN], pa.int32()), pa.array([part], pa.int32()), pa.array([held.tobytes()], pa.binary())], ["group", "part", "held"])

        def per_group(table: pa.Table) -> pa.Table:
            held = sum((np.frombuffer(h, kind) for h in table.sort_by("part")["held"].to_pylist()), np.zeros(size, kind))
            return pa.table({"group": table["group"][:1], "held": pa.array([held.tobytes()], pa.binary())})

        sums = self.blocks.select("data").mapInArrow(per_task, "group int, part int, held binary")
        if self.tasks > FAN_IN:
            sums = sums.groupBy("group").applyInArrow(per_group, "group int, held binary")
        rows = sorted(sums.collect(), key=lambda r: (r["group"], r["part"] if self.tasks <= FAN_IN else 0))
        return sum((np.frombuffer(r["held"], kind) for r in rows), np.zeros(size, kind))

    def product(self, u: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``u``."""
        centred = self.centred()

        def of_block(x):
            y = centred(x)
            return y.T @ (y @ u)

        return self.total(of_block, u.size).reshape(u.shape) / self.n

    def trace(self) -> float:
        centred = self.centred()
        return float(self.total(lambda x: (centred(x) ** 2).sum(), 1)[0]) / self.n

    def covariance_of(self, projection: np.ndarray) -> np.ndarray:
        """Covariance of the rows' ``projection`` (columns): two passes, the second centred by the first."""
        centred, k = self.centred(), projection.shape[1]
        mean = self.total(lambda x: (centred(x) @ projection).sum(axis=0), k) / self.n

        def of_block(x):
            y = centred(x) @ projection - mean
            return y.T @ y

        return self.total(of_block, k * k).reshape(k, k) / self.n


def orthonormal(new: np.ndarray, against: np.ndarray | None = None) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the span of ``against``; projected three times, as one pass loses digits."""
    basis = np.zeros((len(new), 0)) if against is None else against
    before = basis.shape[1]
    for v in new.T:
        for _ in range(3):
            size = np.linalg.norm(v)
            if size == 0:
                break
            v = v / size
            v = v - basis @ (basis.T @ v)
            if np.linalg.norm(v) < 1e-10:
                break
        else:
            basis = np.concatenate([basis, (v / np.linalg.norm(v))[:, None]], axis=1)
    return basis[:, before:]


def minres(apply, right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column of ``right``, in step: ``apply`` multiplies all columns at once."""
    x, v_old, w, w_old = (np.zeros_like(right) for _ in range(4))
    beta = np.linalg.norm(right, axis=0)
    first, eta, live = beta.copy(), beta.copy(), beta > 0
    v = right / np.where(live, beta, 1)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # The newest column of the tridiagonal matrix under the last two rotations, and the rotation that clears it.
        delta, above, far = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        rho = np.hypot(delta, beta_new)
        safe = np.where(rho > 0, rho, 1)
        c_old, s_old, c, s = c, s, delta / safe, beta_new / safe
        w_old, w = w, (v - far * w_old - above * w) / safe
        x = x + np.where(live & (rho > 0), c * eta, 0) * w
        eta, beta = -s * eta, beta_new
        v_old, v = v, p / np.where(beta > 0, beta, 1)
        live &= (np.abs(eta) > tolerance * first) & (beta > EPS * first) & (rho > 0)
    return x


def jacobi_davidson(product, dim: int, wanted: int, steps: int = MINRES_STEPS, most_turns: int = MOST_TURNS) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues (falling) and unit eigenvectors of the symmetric, positive matrix behind ``product``.

    A residual counts as double precision at a few rounding errors of a product, relative to the largest eigenvalue. It is checked with a
    new product in the end. Turns without progress at the rounding limit end the search.
    """
    wanted = min(wanted, dim)
    room, keep = max(4 * wanted, 32), min(2 * wanted, dim)
    tolerance = 16 * np.sqrt(dim) * EPS
    basis = orthonormal(np.random.default_rng([SEED, dim]).standard_normal((dim, keep)))
    image, stuck = product(basis), 0
    for turn in range(most_turns):
        small = basis.T @ image
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1], inner[:, ::-1]
        u, theta = basis @ inner[:, :wanted], values[:wanted]
        residual = image @ inner[:, :wanted] - u * theta
        locked = np.linalg.norm(residual, axis=0) <= tolerance * max(values[0], 0)
        new = np.zeros((dim, 0))
        if not locked.all():
            shift = theta[~locked]

            def projected(v, u=u):
                return v - u @ (u.T @ v)

            def correction(v, shift=shift, projected=projected):
                v = projected(v)
                return projected(product(v) - v * shift)

            new = orthonormal(minres(correction, -projected(residual[:, ~locked]), steps, 2.0 ** -(turn + 2)), basis)
        if new.shape[1] and basis.shape[1] + new.shape[1] <= room:
            basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
            continue
        if new.shape[1]:
            basis = orthonormal(np.concatenate([basis @ inner[:, :keep], new], axis=1))
        else:
            # All locked, or nothing left to add: the wanted Ritz vectors alone, with a new product, to the last digit.
            u = orthonormal(u)
            image, stuck = product(u), stuck + 1
            small = u.T @ image
            values, inner = np.linalg.eigh((small + small.T) / 2)
            values, inner = values[::-1], inner[:, ::-1]
            residual = np.linalg.norm(image @ inner - (u @ inner) * values, axis=0)
            if values[0] <= 0 or stuck > 2 or (residual <= tolerance * values[0]).all():
                return values, orthonormal(u @ inner)
            basis = orthonormal(np.concatenate([u, basis], axis=1))
        image = product(basis)
    raise RuntimeError(f"no convergence in {most_turns} turns")


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of every usable row and each of the leading components."""
    spark = vectors.sparkSession
    rows_at, fit_at = in_scratch(spark, "whitening-rows"), in_scratch(spark, "whitening-fit")
    made = integers(vectors, id_col, vector_col)
    made.write.parquet(rows_at)
    rows = spark.read.schema(made.schema).parquet(rows_at)
    common = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), F.col("dim").desc()).first()
    dim = common["dim"] if common else 1
    rows = rows.where(F.col("dim") == dim)
    blocks = fit_blocks(rows, dim)
    blocks.write.parquet(fit_at)
    fit = FitList(spark.read.schema(blocks.schema).parquet(fit_at), dim)
    n, values, u, error, explained = fit.n, np.zeros(0), np.zeros((dim, 0)), 0.0, np.zeros(0)
    if n > 1:
        values, u = jacobi_davidson(fit.product, dim, components)
        real = values > 64 * dim * EPS * max(values[0], 0)
        values, u = values[real], u[:, real]
    if len(values):
        u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(len(values))])
        explained = values / fit.trace()
        error = float(np.abs(fit.covariance_of(u / np.sqrt(values)) - np.eye(len(values))).max())
    drop_scratch(spark, fit_at)
    centred, whole, rest, k = fit.centred(), fit.whole, fit.rest, len(values)
    projection = u / np.sqrt(values) if k else u

    def deviations(x: np.ndarray) -> list[int | None]:
        away = x - whole
        if n * float(np.abs(away).max(initial=0)) + n < 2**31 / np.sqrt(dim):  # squares add up to less than 2^62
            return ((n * away - rest) ** 2).sum(axis=1).tolist()
        exact = (((n * away.astype(object)) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]

    def work(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = np.frombuffer(b"".join(batch["x"].to_pylist()), "<i8").reshape(-1, dim)
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(at), pa.array((centred(x) @ projection).reshape(-1)),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = made.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(work, schema)
