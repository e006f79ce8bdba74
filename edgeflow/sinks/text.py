"""Text outputs, written in parallel as part files of a folder."""

from pyspark.sql import functions as F

from edgeflow.sources.text import UNREACHED


def write_tuples(df, path):
    """Lines `(a,b,…)`."""
    pattern = "(" + ",".join(["%s"] * len(df.columns)) + ")"
    df.select(F.format_string(pattern, *df.columns).alias("value")).write.text(path)


def write_delimited(df, path, sep=","):
    """Lines of all columns joined by `sep`, which may be empty; NULL is empty text."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.text(path)


def write_named(outputs, path, sep="\t"):
    """Several tables, each in the sub-folder of its name."""
    for name, df in outputs.items():
        write_delimited(df, f"{path}/{name}", sep)


def write_summary(df, path, **labels):
    """The one row of `df` as lines `<label> :<value>`, one per given column, in one file."""
    lines = [
        F.concat(F.lit(f"{label} :"), F.col(column).cast("string"))
        for column, label in labels.items()
    ]
    df.select(F.explode(F.array(*lines)).alias("value")).repartition(1).write.text(path)


def adjacency_lines(states):
    """Vertex states as lines `id-n1,n2:d1:active1:d2:active2` (column value)."""

    def state(i):
        distance = F.coalesce(F.col(f"d{i}"), F.lit(UNREACHED)).cast("string")
        return [distance, F.col(f"active{i}").cast("int").cast("string")]

    neighbours = F.concat_ws(",", F.transform("nbrs", lambda n: n.cast("string")))
    head = F.concat_ws("-", F.col("id").cast("string"), neighbours)
    return states.select(F.concat_ws(":", head, *state(1), *state(2)).alias("value"))


def write_adjacency(states, path):
    adjacency_lines(states).write.text(path)
