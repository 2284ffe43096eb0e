"""What the text operators share: text in Arrow batches, bounded memories, the shared folder.

Conventions of every operator here, unless its docstring says otherwise: a null text counts as an
empty one; rows are independent, so repeated rows get equal results and an empty table gives an empty
one; an output column replaces an input column of the same name (compared without case).
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of text that Python code works on at a time (one longer text is a slice of its own).
SLICE_CHARS = 4 << 20

#: Words are runs of characters other than white space in ASCII.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(_UPPER, _LOWER)


def ascii_lower(text: str) -> str:
    """Lower-case A-Z alone."""
    return text.lower() if text.isascii() else text.translate(ASCII_LOWER)


class Memo(dict):
    """Remembered results of a function, at most `limit` recent and `limit` older ones."""

    def __init__(self, make: Callable, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if hasattr(key, "__len__") and len(key) > self.longest:
            return
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value


def prepare(spark: SparkSession) -> None:
    """Ship this package to executors once per application and bound the bytes of Arrow batches."""
    if spark.conf.get("logpulse.llm.shipped", None) is None:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="logpulse-")) / "logpulse_llm.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.addArtifacts(str(archive), pyfile=True)
        spark.conf.set("logpulse.llm.shipped", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under spark.checkpoint.dir, which all executors share.

    Unset, it is set to a temporary folder where driver and executors are one process (tests);
    on a cluster it must be set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local") or "local-cluster" in spark.conf.get("spark.master", ""):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: the lineage is cut, work done once."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column name as it is written where dots and other signs would be read otherwise."""
    return "`" + name.replace("`", "``") + "`"


def fold(column: str, parts: int) -> Column:
    """crc32 of the decimal text of an id, modulo `parts`; null ids count as the text `null`."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null"))) % parts


def slices(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches of at most about SLICE_CHARS of text, with their texts (null: empty)."""
    for batch in batches:
        texts = [x or "" for x in batch.column(text).to_pylist()]
        start = chars = 0
        for i, x in enumerate(texts):
            if chars and chars + len(x) > SLICE_CHARS:
                yield batch.slice(start, i - start), texts[start:i]
                start, chars = i, 0
            chars += len(x)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def add_columns(df: DataFrame, make: Callable[[], Callable[[list[str]], list]], fields: str | T.StructType, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns computed in Python from a text column, next to the `keep` columns (None: all).

    `make` runs once in each task and gives a function from a list of texts to a list of columns
    (lists or Arrow arrays) in the order of `fields`.
    """
    added = fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)
    taken = {f.name.lower() for f in added}
    kept = [f for f in df.schema if f.name.lower() not in taken and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, *added])
    arrow = to_arrow_schema(schema)
    inputs = [f"_{i}" for i in range(len(kept))]

    def run(batches):
        work = make()
        for batch, texts in slices(batches, "text"):
            own = [batch.column(n) for n in inputs]
            new = [x if isinstance(x, pa.Array) else pa.array(x, type=arrow.field(len(own) + i).type) for i, x in enumerate(work(texts))]
            yield pa.RecordBatch.from_arrays([*(c if c.type == arrow.field(i).type else c.cast(arrow.field(i).type) for i, c in enumerate(own)), *new], schema=arrow)

    return df.select(*(F.col(quoted(f.name)).alias(n) for f, n in zip(kept, inputs)), F.col(quoted(text)).cast("string").alias("text")).mapInArrow(run, schema)
