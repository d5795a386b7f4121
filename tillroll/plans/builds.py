"""Published builds: which load of an input is the current one.

A build is published by a manifest, a small JSON file ``build-<number>.json`` in a
folder of the shared file system that belongs to the input, the target and the
version of this code.  It is written under a temporary name and renamed once the
build is complete, so readers of any application see the old build or the new one,
never a part of one; the highest number is the current build.  An aborted load
publishes nothing and leaves the old one in place.  A reader is pinned to the root
that its manifest names.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

from tillroll.plans.session import builds_dir, file_system, remove_path

_NAME = "build-{:08d}.json"


@lru_cache(maxsize=1)
def code_version() -> str:
    """A digest of the warehouse's code: a build made by other code is not used."""
    package = Path(__file__).resolve().parents[1]
    files = sorted(p for p in package.rglob("*.py") if "llm" not in p.relative_to(package).parts)
    return hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()[:16]


def _folder(spark: SparkSession, source: str, target: str) -> str:
    key = hashlib.sha256(f"{source}\n{target}\n{code_version()}".encode()).hexdigest()[:24]
    return f"{builds_dir(spark)}/{key}"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n[6:-5]) for n in names if n.startswith("build-") and n.endswith(".json"))


def current(spark: SparkSession, source: str, target: str) -> tuple[int, dict] | None:
    """Number and manifest of the current build whose layers still exist."""
    folder = _folder(spark, source, target)
    for number in reversed(_numbers(spark, folder)):
        text = spark.read.option("wholetext", True).text(f"{folder}/{_NAME.format(number)}").first()[0]
        manifest = json.loads(text)
        fs, root = file_system(spark, manifest["root"])
        if fs.exists(root):
            return number, manifest
    return None


def publish(spark: SparkSession, source: str, target: str, manifest: dict) -> int:
    """Make a complete build the current one.  The build it replaces is deleted; if
    another application published that one, its readers may still be at work, and it
    is deleted when the next build replaces this one."""
    folder, before = _folder(spark, source, target), current(spark, source, target)
    app = spark.sparkContext.applicationId
    gone, retired = [], []
    if before:
        old = before[1]
        gone = list(old["retired"])
        if old["root"] != manifest["root"]:  # else it was carried on
            (gone if old["app"] == app else retired).append(old["root"])
    numbers = _numbers(spark, folder)
    number = (numbers[-1] if numbers else 0) + 1
    text = json.dumps({**manifest, "app": app, "retired": retired})
    fs, temporary = file_system(spark, f"{folder}/.{app}-{number}")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = file_system(spark, f"{folder}/{_NAME.format(number)}")
    if fs.exists(final) or not fs.rename(temporary, final):
        raise RuntimeError(f"another load of {source} was published at the same time")
    for root in gone:
        remove_path(spark, root)
    for n in numbers[:-1]:
        fs.delete(file_system(spark, f"{folder}/{_NAME.format(n)}")[1], False)
    return number
