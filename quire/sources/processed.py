"""Prepared data on disk: write, read, and reuse when nothing changed."""

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import drop_stored
from .files import _exists, _file_system, file_state

FINGERPRINT = "quire.fingerprint"


def write_processed(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Parquet, one folder per split so readers open only the split they need.

    Without `overwrite` an existing path is an error, never mixed into.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_processed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if split is None else table.where(table["split"] == split)


def fingerprint(parameters: dict) -> str:
    text = json.dumps(parameters, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def reuse_or_compute(
    spark: SparkSession, path: str, parameters: dict, compute, inputs: list[str] = ()
) -> DataFrame:
    """The stored result for these parameters, computing it when missing.

    `inputs` names the files and folders that `compute` reads: their names,
    sizes and times of change count as parameters, so changed input is computed
    anew. Each run writes a folder of its own and publishes it by a small
    manifest, which appears whole or not at all. So a run that died half way, or
    two that compute at once, never mix their files, and no file is replaced or
    deleted under a reader; of two runs that finish the one that publishes
    first is read by all that come later.
    """
    settings = {**parameters, "inputs": file_state(spark, list(inputs))} if inputs else parameters
    folder = f"{path}/{fingerprint(settings)}"
    published = _published(spark, folder)
    if published is None:
        run = f"run-{uuid.uuid4().hex}"
        write_processed(compute(), f"{folder}/{run}")
        published = _publish(spark, folder, run)
    return read_processed(spark, f"{folder}/{published}")


MANIFEST = "manifest"


def _published(spark: SparkSession, folder: str) -> str | None:
    """The run that the folder's manifest names."""
    name = f"{folder}/{MANIFEST}"
    if not _exists(spark, name):
        return None
    system, path = _file_system(spark, name)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, run: str) -> str:
    """Name `run` in the manifest unless another run is named there by now; the
    run that is named. A run that comes second leaves: nobody has read it."""
    draft = f"{folder}/{MANIFEST}-{run}"
    system, path = _file_system(spark, draft)
    stream = system.create(path, False)
    try:
        stream.write(run.encode())
    finally:
        stream.close()
    _, final = _file_system(spark, f"{folder}/{MANIFEST}")
    first = not system.exists(final) and system.rename(path, final)
    if first:
        return run
    system.delete(path, False)
    drop_stored(spark, f"{folder}/{run}")
    return _published(spark, folder)
