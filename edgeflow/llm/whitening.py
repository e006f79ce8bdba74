"""Whitening of embeddings on distributed block matrices.

The distinct vectors are numbered and centred, and go as indexed rows into a block matrix A. The scatter
matrix AᵀA, as wide as a vector is long, is the only thing that visits the driver, for its eigenvectors;
A times the whitening matrix projects the rows. A block matrix keeps a list of its blocks on the driver
and numbers its rows with 32 bits, so the rows go out in slabs that bound both; the scatter is the sum
over the slabs. In a slab the middle of the product is split, as one task would get all blocks else.
"""

from bisect import bisect_right
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseVector, VectorUDT
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeflow.plans import Rounds, keep

#: Rows of a block, blocks that meet in a task of a product, rows of a slab, and slabs at work at a time.
BLOCK_ROWS, BLOCKS_TOGETHER, SLAB_ROWS, SLABS_TOGETHER = 4096, 8, 1 << 22, 4
#: Columns of a block at most.
BLOCK_COLUMNS = 1024
#: Components with a smaller share of the trace count as rounding errors of none.
NOTHING = 1e-12
#: Entries times the scale stay below this, so that the integers and their differences fit 64 bits.
LARGEST = 2.0**62
#: Bits of `monotonically_increasing_id` that count within a task.
TASK_BITS = 33


def on_integers(rows, scale=64.0, shift=1_000_000, id="vec_id", vector="embedding"):
    """(vec_id, x): entries c as whole numbers floor(scale·c) + shift, written once.

    Rows go whose vector is null, empty, or has an entry that is null, not finite, or 2^62 or more after
    scaling; so do vectors of another length than most have (the shorter among equally frequent).
    """
    given = rows.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("entries"))
    fine = F.forall("entries", lambda c: F.coalesce(F.abs(c * scale) < LARGEST, F.lit(False)))
    whole = F.transform("entries", lambda c: F.floor(c * scale) + F.lit(shift))
    kept = given.where((F.size("entries") > 0) & fine)
    written = keep(kept.select("vec_id", whole.alias("x")), "whitening-rows")
    lengths = written.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "d").first()
    return (written, 0) if first is None else (written.where(F.size("x") == first["d"]), first["d"])


class _Numbered:
    """Distinct vectors (x) with their `index`, counted on from task to task of the table they are written as."""

    def __init__(self, rows):
        marked = rows.select("x").distinct().withColumn("mark", F.monotonically_increasing_id())
        self.written = keep(marked, "whitening-distinct")
        task = F.shiftright("mark", TASK_BITS).cast("int").alias("task")
        counts = sorted(self.written.groupBy(task).agg(F.count(F.lit(1)).alias("n")).collect())  # one row a task
        self.tasks, numbers = [row["task"] for row in counts], [row["n"] for row in counts]
        self.bases = [0, *accumulate(numbers)]
        self.n = self.bases[-1]
        base = rows.sparkSession.createDataFrame(
            [(t, b - (t << TASK_BITS)) for t, b in zip(self.tasks, self.bases)], "task int, base bigint"
        )
        self.indexed = (
            self.written.withColumn("task", task).join(F.broadcast(base), "task")
            .select("mark", "x", (F.col("base") + F.col("mark")).alias("index"))
        )

    def _mark(self, index):
        place = min(bisect_right(self.bases, index) - 1, len(self.tasks) - 1)
        return (self.tasks[place] << TASK_BITS) + index - self.bases[place]

    def slab(self, first, last):
        """Rows with first ≤ index < last, counted from 0; the marks prune the files that are read."""
        between = F.col("mark").between(self._mark(first), self._mark(last - 1))
        return self.indexed.where(between).withColumn("index", F.col("index") - first)


class _Moments:
    """Exact count and sums of the distinct vectors, and the columns made with them."""

    def __init__(self, numbered):
        each = numbered.written.select(F.posexplode("x").alias("place", "x"))
        total = F.sum(F.col("x").cast("decimal(20,0)")).alias("total")
        found = sorted(each.groupBy("place").agg(total, F.min("x").alias("least"), F.max("x").alias("most")).collect())
        self.n, self.sums = numbered.n, [int(row["total"]) for row in found]
        #: whole part of each mean, and what is left of the sum
        self.means, self.rests = [s // self.n for s in self.sums], [s % self.n for s in self.sums]
        self.widest = max(
            max(row["most"] - mean, mean - row["least"]) + 1 for row, mean in zip(found, self.means)
        )

    def _off(self):
        means = F.lit(self.means).cast("array<bigint>")
        return F.zip_with("x", means, lambda x, mean: x - mean)

    def centred(self):
        """x minus its mean, as double."""
        rests = F.lit([rest / self.n for rest in self.rests]).cast("array<double>")
        return F.zip_with(self._off(), rests, lambda off, rest: off.cast("double") - rest)

    def deviation(self):
        """Sum of (n·x − S)² as decimal(38,0); null if it takes more digits."""
        fits = (self.n * self.widest) ** 2 * len(self.means) < 1 << 63
        kind = "bigint" if fits else "decimal(38,0)"
        rests = F.lit([str(rest) for rest in self.rests]).cast(f"array<{kind}>")
        part = "bigint" if fits else "decimal(20,0)"
        count = F.lit(str(self.n)).cast(part)
        far = F.zip_with(self._off(), rests, lambda off, rest: (off.cast(part) * count - rest).cast(kind))
        squares = F.transform(far, lambda v: F.try_multiply(v, v).cast(kind))
        total = F.aggregate(squares, F.lit(0).cast(kind), lambda a, v: F.try_add(a, v).cast(kind))
        return total.cast("decimal(38,0)")


def _product(a, b, splits=1):
    """a·b of block matrices with the middle dealt over `splits` times the tasks; Python's own method has no splits."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def _scatter(a):
    blocks = -(-a.numRows() // a.rowsPerBlock)
    return _product(a.transpose(), a, max(1, blocks // BLOCKS_TOGETHER)).toLocalMatrix().toArray()


def _blocks(slab, centred, rows, d, block_rows):
    """The centred rows of a slab as a block matrix."""
    # the blocks of a tall matrix go to as many tasks as the root of the partitions they come from
    spread = slab.repartition(max(1, -(-rows // block_rows)), "index")
    vectors = spread.select("index", array_to_vector(centred).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), rows, d)
    return matrix.toBlockMatrix(block_rows, min(d, BLOCK_COLUMNS))


def _local(spark, matrix):
    """A small numpy matrix as a block matrix that the blocks of rows can be multiplied by."""
    kind = T.StructType([T.StructField("index", T.LongType()), T.StructField("vector", VectorUDT())])
    rows = spark.createDataFrame([(i, DenseVector(row)) for i, row in enumerate(matrix)], kind)
    height, width = matrix.shape
    return IndexedRowMatrix(rows, height, width).toBlockMatrix(min(height, BLOCK_COLUMNS), width)


def components(scatter, n, k):
    """(values, vectors): the `k` largest eigenvalues of scatter / n and their unit eigenvectors, falling."""
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(values.sum())
    held = [i for i in range(min(k, len(values))) if values[i] > NOTHING * trace]
    return values[held], vectors[:, held], trace


def whiten(
    rows, k=16, scale=64.0, shift=1_000_000, id="vec_id", vector="embedding", block_rows=BLOCK_ROWS, slab_rows=SLAB_ROWS
):
    """Each vector on the `k` strongest components of the distinct ones: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Vectors become whole numbers first (`on_integers` says which rows go). Count n, sums S, covariance and components are
    of the distinct vectors, each once, the covariance of centred rows with divisor n. Components are
    numbered from 1 by falling variance e; one whose variance is nothing but rounding errors has no row,
    so vectors that are all equal, or a single one, give none, nor does an empty table. A row for each
    row left and component, repeated rows and ids included, null ids too:
    `deviation` is the exact sum of (n·x − S)² as decimal(38,0) (null beyond 38 digits), `whitened` the
    projection of x − S/n divided by the root of e, `explained` e as a share of the trace, and
    `identity_error` one number, the largest entry of the covariance of the whitened vectors minus the
    identity. Equal variances leave their components free to turn among themselves. Other columns are
    not read, whatever their names. The driver holds a square matrix as wide as a vector is long.
    """
    spark = rows.sparkSession
    kind = rows.schema[id].dataType.simpleString()
    nothing = spark.createDataFrame(
        [], f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    written, d = on_integers(rows, scale, shift, id, vector)
    if not d:
        return nothing
    numbered = _Numbered(written)
    moments = _Moments(numbered)
    n, bounds = numbered.n, [*range(0, numbered.n, slab_rows), numbered.n]
    slabs = list(zip(bounds, bounds[1:]))

    def matrix(slab):
        first, last = slab
        return _blocks(numbered.slab(first, last), moments.centred(), last - first, d, block_rows)

    with ThreadPoolExecutor(SLABS_TOGETHER) as pool:
        scatter = sum(pool.map(lambda slab: _scatter(matrix(slab)), slabs))
    values, vectors, trace = components(scatter, n, k)
    if not len(values):
        return nothing
    turned = _local(spark, vectors / np.sqrt(values))
    projected = Rounds(spark, "whitening-projected", "index bigint, whitened array<double>")

    def project(slab):
        z = _product(matrix(slab), turned)
        lines = callMLlibFunc("getIndexedRows", z.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        index = (F.col("index") + slab[0]).alias("index")
        projected.write(slab[0] // slab_rows, lines.select(index, vector_to_array("vector").alias("whitened")))
        return _scatter(z)

    with ThreadPoolExecutor(SLABS_TOGETHER) as pool:
        covariance = sum(pool.map(project, slabs)) / n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    # one row for each distinct vector; the rows of a frequent one are a skewed partition that can be split
    of = numbered.indexed.select("index", "x", moments.deviation().alias("deviation")).join(
        projected.all().select("index", "whitened"), "index"
    )
    each = written.join(of.select("x", "deviation", "whitened"), "x")
    explained = F.lit([float(value / trace) for value in values])
    return each.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
