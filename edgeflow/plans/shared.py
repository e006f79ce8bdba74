"""Tables written to the folder all executors share.

Loops cut their lineage here: the state of each round is a Parquet table, so a lost executor costs
the running round only, the plan of a round never grows, and Catalyst knows the size of the state.
"""

import itertools
import tempfile
import uuid

#: Rows of a few numbers that a task holds in a cached partition.
PARTITION_ROWS = 4_000_000

_session_folders = {}
_numbers = itertools.count()


def _root(spark):
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="edgeflow-")


def _folder(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _session_folder(spark):
    """The folder of this session below the shared folder; it goes when the session's JVM ends."""
    application = spark.sparkContext.applicationId
    if application not in _session_folders:
        path = f"{_root(spark).rstrip('/')}/edgeflow-{application}-{uuid.uuid4().hex}"
        filesystem, target = _folder(spark, path)
        filesystem.mkdirs(target)
        filesystem.deleteOnExit(target)
        _session_folders[application] = path
    return _session_folders[application]


def drop_written(spark):
    """Delete all tables this session wrote to the shared folder; results that read them go too."""
    path = _session_folders.pop(spark.sparkContext.applicationId, None)
    if path:
        filesystem, target = _folder(spark, path)
        filesystem.delete(target, True)


def new_folder(spark, name):
    """A name for a new folder that every executor can reach."""
    return f"{_session_folder(spark)}/{name}-{next(_numbers)}"


def keep(df, name, **options):
    """Write `df` once to the shared folder, with options of the Parquet writer, and return the written table."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark, rows=0, each=None):
    """Partition count for tables that stay partitioned on a key over many rounds.

    The session's count is the least, as Spark would shuffle a smaller one again; more than that for
    more than `each` of `rows` (PARTITION_ROWS if not given) in a partition.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (each or PARTITION_ROWS)))


class Rounds:
    """The state of a loop, one table per round, readable together with its `round` column."""

    def __init__(self, spark, name, schema):
        self.spark, self.schema = spark, schema
        self.path = new_folder(spark, name)

    def write(self, number, df):
        df.write.parquet(f"{self.path}/round={number}")
        return self.read(number)

    def read(self, *numbers):
        paths = [f"{self.path}/round={number}" for number in numbers]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def all(self):
        return self.spark.read.schema(f"{self.schema}, round int").parquet(self.path)

    def drop(self):
        """Delete all rounds; what was read from them must be written by then."""
        filesystem, target = _folder(self.spark, self.path)
        filesystem.delete(target, True)
