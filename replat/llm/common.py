"""What several operators share: input columns, worker-wide state, staged tables."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replat.checkpoints import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Rows hold whole texts, so fewer of them go to a Python worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that extra columns can't clash with its own."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _worker_state() -> dict[str, Any]:
    """What the Python worker keeps from task to task."""
    return sys.modules.setdefault("replat_worker_state", types.ModuleType("replat_worker_state")).__dict__


def once(name: str, make: Callable[[], Any]) -> Any:
    """A value made once per Python worker (a vocabulary, a cache), whatever task asks first."""
    state = _worker_state()
    if name not in state:
        state[name] = make()
    return state[name]


def new_task(operator: str) -> None:
    """For the first line of an operator's tasks: workers outlive stages and share the executor's memory, so what other
    operators keep by ``once`` goes, and so does memory that earlier tasks have freed but not given back."""
    state = _worker_state()
    if state.get("operator") != operator:
        for name in [n for n in state if not n.startswith("__")]:  # the module's own names stay
            del state[name]
        state["operator"] = operator
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def staged(df: DataFrame, **options: Any) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, and lost executors lose nothing.

    Staged tables are compressed columns; like checkpoint files they stay until the folder is cleared. ``options`` are
    the writer's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The deployment's number of shuffle partitions; hash buckets follow it, so that it sizes tasks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[Any], rows: int = 4000) -> Iterator[Any]:
    """The batches in smaller pieces, so that few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def in_blocks(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters; every text is in exactly one."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
