"""Helpers that several operators of this subpackage share."""

import io
import itertools
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

import edgeflow
from edgeflow.plans import new_folder

#: Applications whose workers have this package.
_shipped = set()

#: Bytes of text that a Python task works on at a time.
SLICE_BYTES = 4_000_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ship(spark):
    """Give the Python workers this package, by way of the folder all executors share."""
    context, root = spark.sparkContext, Path(edgeflow.__file__).parent
    if context.applicationId in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = f"{new_folder(spark, 'code')}/{root.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def mapped(df, function, schema):
    """`df.mapInArrow` with a function of this package."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def unused(df, name):
    """`name`, lengthened until `df` has no such column (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in itertools.chain([name], (f"{name}_{i}" for i in itertools.count(1))) if n.lower() not in taken)


def fold(doc_id, folds=4):
    """crc32 of the id as text, modulo `folds`; null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def let(value, use):
    """use(value) with `value` worked out once for a row, though `use` has it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_bytes(text):
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def slices(batches, column, limit=SLICE_BYTES):
    """Record batches cut so that `column` (binary) holds about `limit` bytes in each, a row at least."""
    for batch in batches:
        start, held = 0, 0
        for i, value in enumerate(batch.column(column)):
            held += len(value.as_buffer()) if value.is_valid else 0
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def int_lists(values, counts):
    """A list column of the given counts over flat numpy values."""
    offsets = [0, *itertools.accumulate(counts)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
