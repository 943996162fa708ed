"""Small helpers shared by the operators: free column names, written tables and their removal, a worker's cache."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from ..sources import scratch

#: The white space of the word rules: space and U+0009 to U+000D.
WORD_SPACE = r"[\x20\x09-\x0D]+"

#: Scratch tables of the pipeline stage that runs or ran last.
_STAGE = {"running": False, "paths": []}

#: Bytes of a row group of written tables: what a writer holds in memory at most, long texts included.
ROW_GROUP = 16 << 20


def free_name(df, name):
    """name, with underscores appended until no column of df is called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name):
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def body(name):
    return F.coalesce(col(name), F.lit(""))


def written(df, name):
    """df as a table in the shared scratch folder: later steps start from files that survive a lost executor."""
    spark = df.sparkSession
    path = scratch.fresh(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    if _STAGE["running"]:
        _STAGE["paths"].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage(spark):
    """A pipeline stage: what the stage before it wrote to scratch is deleted, since its result has been stored by now.

    Tables that queries write outside of stages are left alone."""
    while _STAGE["paths"]:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGE["paths"].pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _STAGE["running"] = True
    try:
        yield
    finally:
        _STAGE["running"] = False


_KEPT = {}


def kept(key, make):
    """make(), kept by this worker for as long as it works for the same key: one such object at a time.

    A worker that goes on with another operator thereby frees the caches of the one before."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release():
    """Frees what this worker keeps; operators that keep nothing call it, so that no cache of another one stays beside them."""
    _KEPT.clear()


class Remembered(dict):
    """make(key) for every key asked for, in a worker's bounded memory: the latest two generations of size entries.

    fixed entries stay for good; keys over long characters are never kept."""

    def __init__(self, make, size, fixed=(), long=100):
        super().__init__(fixed)
        self.make, self.size, self.fixed, self.long, self.old = make, size, dict(fixed), long, {}

    def __missing__(self, key):
        value = self.old.get(key)
        return self.keep(key, self.make(key) if value is None else value)

    def keep(self, key, value):
        if len(key) <= self.long:
            if len(self) >= self.size + len(self.fixed):
                self.old = dict(self)
                self.clear()
                self.update(self.fixed)
            self[key] = value
        return value


def stored(df, name):
    """df written to the scratch folder and read again; stages leave it."""
    path = scratch.fresh(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
