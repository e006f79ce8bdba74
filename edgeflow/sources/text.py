"""Text inputs. Paths may name a file, a folder or a glob."""

from functools import reduce

from pyspark.sql import functions as F

from edgeflow.operators.edges import filter_max_id
from edgeflow.schema import COUNT, EDGE

# Text that stands for "not reached" in a vertex line.
UNREACHED = 2147483647


def _csv(spark, schema, mode, **options):
    return spark.read.schema(schema).options(
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode=mode, **options
    )


def read_edges(spark, path, mode="PERMISSIVE", max_id=None):
    """Comma text without header as edges (src, dst); `max_id` keeps edges with both ends below it.

    PERMISSIVE drops lines without two numbers, FAILFAST raises on them.
    """
    edges = _csv(spark, EDGE, mode).csv(path)
    return filter_max_id(edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()), max_id)


def read_edges_text(spark, path, strict=False):
    """Edges from the first two comma fields of each line.

    A line without two numbers is dropped, or raises if `strict`.
    """
    fields = F.split("value", ",")

    def number(i):
        field = F.trim(F.get(fields, F.lit(i)))
        if not strict:
            return field.try_cast("bigint")
        return F.coalesce(field.cast("bigint"), F.raise_error(F.concat(F.lit("no edge: "), "value")))

    edges = spark.read.text(path).select(number(0).alias("src"), number(1).alias("dst"))
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def read_nodes(spark, path):
    """Vertex ids, one or several per line, separated by white space: (id)."""
    tokens = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("token"))
    ids = tokens.select(F.col("token").try_cast("bigint").alias("id"))
    return ids.where(F.col("id").isNotNull())


def read_centroid_seeds(spark, path):
    """The first tab field of every line of every file below `path`: (centroid)."""
    seeds = _csv(spark, "centroid bigint", "PERMISSIVE", sep="\t", recursiveFileLookup=True).csv(path)
    return seeds.where(F.col("centroid").isNotNull())


def read_counts(spark, path):
    """Tab text of an earlier count: (id, n)."""
    return _csv(spark, COUNT, "PERMISSIVE", sep="\t").csv(path)


def tagged_union(**inputs):
    """Several inputs of the same columns in one table, each row with the name of its input."""
    tagged = [df.withColumn("tag", F.lit(tag)) for tag, df in inputs.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def initial_states(adjacency, source1, source2):
    """Vertices with their neighbours and two distances, 0 and active at the source, else unknown."""

    def start(source, i):
        is_source = F.col("id") == source
        return [F.when(is_source, F.lit(0)).alias(f"d{i}"), is_source.alias(f"active{i}")]

    neighbours = F.transform("nbrs", lambda e: e["id"]).alias("nbrs")
    return adjacency.select("id", neighbours, *start(source1, 1), *start(source2, 2))


def parse_adjacency(lines):
    """Vertex lines `id-n1,n2:d1:active1:d2:active2` (column value) as typed columns."""
    pattern = r"^(-?\d+)-([^:]*):(\d+):([01]):(\d+):([01])$"

    def part(i):
        return F.regexp_extract("value", pattern, i)

    neighbours = F.filter(F.split(part(2), ","), lambda n: n != "")
    return lines.where(F.col("value").rlike(pattern)).select(
        part(1).cast("bigint").alias("id"),
        F.transform(neighbours, lambda n: n.cast("bigint")).alias("nbrs"),
        F.nullif(part(3).cast("int"), F.lit(UNREACHED)).alias("d1"),
        (part(4) == "1").alias("active1"),
        F.nullif(part(5).cast("int"), F.lit(UNREACHED)).alias("d2"),
        (part(6) == "1").alias("active2"),
    )


def read_adjacency(spark, path):
    return parse_adjacency(spark.read.text(path))
