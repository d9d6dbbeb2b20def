"""Session set-up and the few helpers every module needs."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "vacantia", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` overrides single settings (dots written as ``__``)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.redaction.regex": "(?i)secret|password|token|access[.]key|app_id|app_key|api_key|api-key",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    if master or "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(master or "local[*]")
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: the driver serves it to them, once per application.

    ``get_spark`` does so; operators that use Python workers also call it, for sessions made elsewhere."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="vacantia-")) / "vacantia.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_dir(spark: SparkSession) -> str:
    """The application's folder below the session's ``spark.checkpoint.dir``, which all executors share.

    Where the session names none, a temporary one is set in local mode (tests on one machine); on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="vacantia-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written to the reliable checkpoint folder and read again."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Of queries planned and run inside, the shuffle files are deleted as each ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Scratch:
    """Intermediate tables as compressed files in the checkpoint folder; leaving the block deletes those that ``drop`` has not.

    ``keep`` cuts the lineage as ``cut_lineage`` does, which writes rows uncompressed and frees nothing before the
    driver collects garbage. What is returned from the block must not read them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._kept = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*[df for df, _ in self._kept.values()])

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read again; its shuffle files are deleted."""
        path = f"{_checkpoint_dir(self._spark)}/{uuid.uuid4().hex}"
        with shuffles_dropped(self._spark):
            df.select("*").write.option("compression", "zstd").parquet(path)
        back = self._spark.read.schema(df.schema).parquet(path)
        self._kept[id(back)] = back, path
        return back

    def drop(self, *dfs: DataFrame) -> None:
        """Deletes the files of what ``keep`` gave."""
        sc = self._spark.sparkContext
        for df in dfs:
            path = sc._jvm.org.apache.hadoop.fs.Path(self._kept.pop(id(df))[1])
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut_partitioned(df: DataFrame, key: str) -> DataFrame:
    """``df`` cut from its lineage, partitioned by and sorted within partitions by ``key``.

    Unlike after ``cut_lineage``, later joins and aggregates by ``key`` know of the partitioning and shuffle
    nothing; for that, the one job that writes it runs without adaptive execution, which hides it."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(df.repartition(key).sortWithinPartitions(key))
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


#: Fixed value: the characters of Unicode's White_Space, spelled out so that every engine reads them alike.
BLANKS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip_blanks(c: Column) -> Column:
    """``c`` without leading and trailing white space of any kind (``trim`` removes U+0020 only)."""
    return F.regexp_replace(c, f"^{BLANKS}+|{BLANKS}+$", "")


def squash_blanks(c: Column) -> Column:
    """``c`` without outer white space and with every inner run of it made one blank."""
    return F.trim(F.regexp_replace(c, f"{BLANKS}+", " "))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name``, computed once per row however often later steps use it.

    The optimiser merges projections and copies expressions into filters; a generator is what it leaves alone,
    and one over an array of a single element costs nothing and keeps every row."""
    return df.select("*", F.explode(F.array(value)).alias(name))
