"""Session helpers: shared scratch tables (lineage cuts) and rows in force.

Iterative operators cut lineage by writing a Parquet table into the folder the
cluster names in ``spark.checkpoint.dir`` and reading it back.  The folder is
shared by all executors, so a lost executor costs a re-read, never a recompute
of the whole loop.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

_KEY = "spark.checkpoint.dir"
_kept: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Where none is set, a temporary one in local mode; on a cluster no folder of
    one machine is shared by all, so that is an error.
    """
    path = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="geoweave-")
        spark.conf.set(_KEY, path)
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _sweep() -> None:
    for path, spark in list(_kept.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: the folder's owner clears it
            return


class Scratch:
    """Written intermediate tables of one operator run.

    ``save`` writes and re-reads a frame; ``drop`` removes a table that no later
    step reads.  Tables the result still reads stay until the process ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/geoweave/{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}
        _kept[self.root] = spark

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = f"{self.root}/{self._n:03d}-{name}"
        self._n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            path = getattr(df, "_scratch_path", None)
            if path:
                _delete(self.spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_force(df: DataFrame, key: str, columns: list[str], stamp: str = "loadedAt") -> DataFrame:
    """The delivery with the greatest ``stamp`` per key; only ``columns`` are carried.

    A grouped ``max_by`` rather than a window: it combines map-side, so a key
    delivered very many times never gathers in one task.  A null stamp counts as
    older than any other; rows with a null key are no record and are left out.
    """
    rest = [c for c in columns if c != key]
    order = F.coalesce(F.col(stamp).cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz"))
    if rest and all(isinstance(df.schema[c].dataType, (NumericType, BooleanType)) for c in rest):
        # Plain numbers aggregate in place, by hash; every column takes the same row, since all see the same order.
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in rest])
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(key, *[F.col("_r")[c].alias(c) for c in rest])


def fold(c: Column) -> Column:
    """Lower case without the accents of Latin letters (fixed letter table below)."""
    return F.translate(F.lower(c), _FROM, _TO)


# Accented Latin letters and their plain forms, one to one.
_FROM = "áàâäãåāăąćčçďđéèêëēėęěíìîïīįłľńňñóòôöõøōőŕřśšşťţúùûüūůűųýÿźžżğ"
_TO = "aaaaaaaaacccddeeeeeeeeiiiiiillnnnoooooooorrsssttuuuuuuuuyyzzzg"
assert len(_FROM) == len(_TO)
