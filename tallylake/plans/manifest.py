"""Which run of an output folder is the published one.

Every run writes into a folder of its own, ``runs/<name>``, and is published by one small file,
``manifests/<number>``, that names it. The file gets its content under another name and is then
renamed, so it is there whole or not at all; the highest number counts. Until then, and for
ever if the run fails, readers see the run before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tallylake.sources import storage

KEEP_RUNS = 2


def _numbers(spark: SparkSession, output: str) -> list[int]:
    names = storage.names(spark, f"{output}/manifests")
    return sorted(int(name) for name in names if name.isdigit())


def _path(output: str, number: int) -> str:
    return f"{output}/manifests/{number:012d}"


def new_run(output: str) -> str:
    """A folder for a run that nobody reads yet."""
    return f"{output}/runs/{uuid.uuid4().hex}"


def current(spark: SparkSession, output: str) -> str:
    """The folder of the published run."""
    numbers = _numbers(spark, output)
    if not numbers:
        raise FileNotFoundError(f"no finished run in {output}")
    return f"{output}/runs/{_read(spark, output, numbers[-1])}"


def _read(spark: SparkSession, output: str, number: int) -> str:
    return json.loads(storage.read_text(spark, _path(output, number)))["run"]


def publish(spark: SparkSession, output: str, run: str, keep: int = KEEP_RUNS) -> int:
    """Make ``run`` the published one and remove runs published before the last ``keep``.

    Two runs that end at the same time take different numbers, or the later one fails.
    """
    numbers = _numbers(spark, output)
    number = numbers[-1] + 1 if numbers else 0
    entry = json.dumps({"run": run.rsplit("/", 1)[-1]})
    storage.write_once(spark, entry, _path(output, number))
    for old in numbers[: max(0, len(numbers) + 1 - keep)]:
        storage.remove(spark, f"{output}/runs/{_read(spark, output, old)}")
        storage.remove(spark, _path(output, old))
    return number
