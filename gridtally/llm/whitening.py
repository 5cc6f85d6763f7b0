"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows are the distinct vectors of whole numbers floor(scale * entry), centred: the matrix A. With
right vectors v and left vectors u, each step forms A v, takes off what lies along the earlier left
vectors, and forms A^T u, without what lies along the earlier right vectors. Both lists stay
orthonormal to rounding, and A V = U B with an upper bidiagonal B, whose small singular value
decomposition holds the components and their deviations.

A left vector has an entry for each row of A and never leaves the tasks: it is A w for a short w
that the driver holds, so a task forms its entries from its own rows and multiplies them by its rows
at once. One job a step makes both products; the driver sees as many numbers as a vector has
dimensions, added up on the cluster. As many steps as dimensions decompose A whole, so equal
deviations are found in their number, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace, gather, ship

#: Vectors in a row of the table that the steps read.
_BLOCK = 4096
#: Entries as whole numbers stay below this, which keeps the sums of a block exact.
_LARGEST = 1 << 40
#: What is below this share of the matrix' norm is rounding.
_ROUNDING = 1e-13


@dataclass
class Whitening:
    """n distinct vectors, their sums by dimension, one component a row with its eigenvalue of the
    covariance and share of the trace, and the largest error of the whitened covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_vectors(frame: DataFrame, name: str, vector: str, scale: int) -> DataFrame:
    """(id, x) of the rows whose vector is not null and has finite entries only."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(entries, lambda c: F.floor(F.lit(scale) * c))
    return frame.where(F.col(vector).isNotNull() & finite).select(F.col(name).alias("id"), x.alias("x"))


def _rows_of(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of each length, and their entries as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        entries = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        if len(entries) and np.abs(entries).max() >= _LARGEST:
            raise ValueError("an entry is too large for exact sums")
        yield places, entries.reshape(len(places), length)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gather(batches):
        for _, x in _rows_of(batch.column("x")):
            for k in range(0, len(x), _BLOCK):
                part = np.ascontiguousarray(x[k : k + _BLOCK])
                yield pa.RecordBatch.from_pydict(
                    {
                        "length": pa.array([x.shape[1]], pa.int32()),
                        "vectors": pa.array([len(part)], pa.int64()),
                        "entries": pa.array([part.tobytes()], pa.binary()),
                    }
                )


def _totals(count: Callable[[np.ndarray], np.ndarray], length: int, kind: pa.DataType):
    """One row for each number that `count` makes of a task's blocks, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("entries"):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, length)
                total = count(x) if total is None else total + count(x)
        if total is not None:
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total, kind)], ["place", "value"])

    return run


def _added(blocks: DataFrame, count: Callable[[np.ndarray], np.ndarray], length: int, kind: str) -> np.ndarray:
    arrow = pa.int64() if kind == "long" else pa.float64()
    each = blocks.mapInArrow(_totals(count, length, arrow), f"place int, value {kind}")
    rows = each.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(rows)])


def _without(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """x without its part along the orthonormal rows of `basis`; twice, as the first leaves rounding."""
    for _ in range(2):
        x = x - (basis @ x) @ basis
    return x


def _decomposed(products: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, norm: float, steps: int):
    """Deviations (singular values) of A and its right vectors, one a row, largest first.

    products(w) gives the squared length of A w, and A^T A w.
    """
    dice = np.random.default_rng(11)
    right, left, images = (np.zeros((0, size)) for _ in range(3))
    small = np.zeros((min(steps, size), min(steps, size)))

    def fresh() -> np.ndarray:
        v = _without(dice.standard_normal(size), right)
        return v / np.linalg.norm(v)

    v, link, started = fresh(), 0.0, True
    while len(right) < min(steps, size):
        j, right = len(right), np.vstack((right, v))
        w = v
        for _ in range(2):
            w = w - (images @ w) @ left
        squared, image = products(w)
        alpha = np.sqrt(squared)
        if started and alpha <= _ROUNDING * norm:
            break  # a vector of no special kind: all that is left is null
        if link:
            small[len(left) - 1, j] = link
        link = 0.0
        if alpha > _ROUNDING * norm:
            small[len(left), j] = alpha
            left, images = np.vstack((left, w / alpha)), np.vstack((images, image / alpha))
            rest = _without(images[-1], right)
            beta = float(np.linalg.norm(rest))
            if beta > _ROUNDING * norm:
                v, link, started = rest / beta, beta, False
                continue
        if len(right) < size:
            v, started = fresh(), True
    _, deviations, turned = np.linalg.svd(small[: max(1, len(left)), : len(right)])
    kept = min(len(deviations), len(left))
    vectors = turned[:kept] @ right
    return deviations[:kept], vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_whitening(vectors: DataFrame, components: int, steps: int | None = None) -> Whitening | None:
    """The whitening of the distinct vectors in `vectors` (x); None if they do not vary.

    Vectors of another length than most (ties: the longer) are left out. `steps` below the number of
    dimensions makes the leading components of very long vectors in fewer jobs, to a precision that
    depends on the gaps between deviations.
    """
    spark = vectors.sparkSession
    ship(spark)
    space = Workspace(spark, "whitening")
    cut = vectors.select("x").distinct().mapInArrow(_blocks, "length int, vectors long, entries binary")
    blocks = space.keep(cut, "blocks")
    lengths = blocks.where("length > 0").groupBy("length").agg(F.sum("vectors").alias("vectors"))
    most = lengths.orderBy(F.desc("vectors"), F.desc("length")).first()
    if most is None:
        space.drop("blocks")
        return None
    size, n = most["length"], most["vectors"]
    blocks = blocks.where(F.col("length") == size).select("entries")

    sums = _added(blocks, lambda x: x.sum(axis=0), size, "long")
    mean = sums / n

    def spread(x: np.ndarray) -> np.ndarray:
        return np.array([np.square(x - mean).sum()])

    total = float(_added(blocks, spread, size, "double")[0])

    def products(w: np.ndarray) -> tuple[float, np.ndarray]:
        def both(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ w
            return np.concatenate(([u @ u], u @ centred))

        out = _added(blocks, both, size, "double")
        return float(out[0]), out[1:]

    if not total:
        space.drop("blocks")
        return None
    deviations, axes = _decomposed(products, size, np.sqrt(total), steps or size)
    kept = min(components, int(np.count_nonzero(deviations > _ROUNDING * np.sqrt(total))))
    eigenvalues, axes = deviations[:kept] ** 2 / n, axes[:kept]
    scaled = axes.T / np.sqrt(eigenvalues)

    def whitened(x: np.ndarray) -> np.ndarray:
        t = (x - mean) @ scaled
        return np.concatenate((t.sum(axis=0), (t.T @ t).ravel()))

    seen = _added(blocks, whitened, size, "double") / n
    covariance = seen[kept:].reshape(kept, kept) - np.outer(seen[:kept], seen[:kept])
    error = float(np.abs(covariance - np.eye(kept)).max())
    space.drop("blocks")
    return Whitening(n, sums, axes, eigenvalues, eigenvalues * n / total, error)


def _placed(fitted: Whitening, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = fitted.components.shape
        scaled = fitted.components.T / np.sqrt(fitted.eigenvalues)
        for batch in batches:
            for places, x in _rows_of(batch.column("x")):
                if x.shape[1] != size:
                    continue
                rough = np.square(x * float(fitted.n) - fitted.sums).sum(axis=1)
                if len(rough) and rough.max() >= 2.0**62:
                    raise ValueError("a deviation does not fit into 64 bits")
                apart = x * fitted.n - fitted.sums
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(np.repeat(places, kept))).cast(id_type),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * kept, fitted.n)),
                        pa.array(np.repeat(np.square(apart).sum(axis=1), kept)),
                        pa.array(((apart / fitted.n) @ scaled).ravel()),
                        pa.array(np.tile(fitted.explained, n)),
                        pa.array(np.full(n * kept, fitted.identity_error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitening(
    frame: DataFrame, name: str, vector: str, components: int = 4, scale: int = 256, steps: int | None = None
) -> DataFrame:
    """A row for each vector of `frame` and component: `name`, component (from 1), n, deviation,
    whitened, explained, identity_error.

    Rows whose vector is null, or holds a null or an entry that is not finite, are left out, and so
    are vectors of another length than most. Repeated vectors count once in the fit, and each of
    their rows is returned; a null name stays null. Fewer components come back if the vectors vary
    in fewer directions: none at all from an empty table, or one distinct vector. An entry beyond
    2**40 / scale, or a deviation beyond 64 bits, is an error. Other columns are ignored.
    """
    vectors = whole_vectors(frame, name, vector, scale)
    columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit_whitening(vectors, components, steps)
    if fitted is None or not len(fitted.components):
        none = vectors.where("false").select(F.col("id").alias(name))
        return none.select(name, *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = vectors.schema["id"].dataType
    done = vectors.mapInArrow(_placed(fitted, to_arrow_type(kind)), f"id {kind.simpleString()}, {columns}")
    return done.withColumnRenamed("id", name)
