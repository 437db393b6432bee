"""What the operators of this folder share: shared-folder tables, checked broadcasts, tokenizer files."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids sent to every executor at most (16 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 500_000


#: Spark removes the shuffle files of an execution when it ends, instead of when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one set on the context.

    Without either it is an error: a folder of one machine would lose what other machines write.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that the driver and all executors share")
        # one process: all tasks see the driver's folder
        found = "file://" + tempfile.mkdtemp(prefix="skerry-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: The runs that ``released`` frees.
_held: list[Scratch] | None = None


class Scratch:
    """Written tables of one run; ``put`` cuts the lineage, ``drop`` frees the files of tables no longer read.

    A returned DataFrame reads the tables that are left, so they stay until the caller has its rows: see ``released``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        if _held is not None:
            _held.append(self)

    def put(self, df: DataFrame) -> DataFrame:
        """df as written to the shared folder and reread; nothing of its shuffles is left on disk."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        before = self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._skerry_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            self._delete(df._skerry_path)

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def released() -> Iterator[None]:
    """Frees all that operators write inside it at its end; results must have been written elsewhere by then."""
    global _held
    before, _held = _held, []
    try:
        yield
    finally:
        for scratch in _held:
            scratch.close()
        _held = before


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has no more than so many rows; it reads one row more than that at most."""
    return df.limit(rows + 1).count() <= rows


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its row count allows it; otherwise df, and the join shuffles both sides."""
    return F.broadcast(df) if small(df, rows) else df


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in ids.doc_id; rows with a null doc_id stay."""
    return docs.join(checked_broadcast(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)


def without_rows(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id and text hash (xxhash64, null as empty) are in bad(bad_id, bad_hash); null ids count as equal."""
    bad = checked_broadcast(bad)
    mine = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (mine == bad["bad_hash"]), "left_anti")


def tokenizer_path(name: str) -> str:
    """Where the installed package keeps a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
