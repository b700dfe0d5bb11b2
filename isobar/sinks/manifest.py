"""Which folders of a store count: small numbered files, the last of which is the truth.

A writer first writes its data into a folder of its own and then commits one manifest that
names all folders that count from now on. Whatever happens before that, readers go on with
the manifest before; a folder that no manifest names is never read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

_FOLDER = "_manifests"
#: Manifests kept beside the newest: enough to go back, few enough to list.
KEPT = 20


class Conflict(RuntimeError):
    """Another writer has committed since the manifest was read."""


@dataclass(frozen=True)
class Manifest:
    """``parts`` are folders below the store, ``covered`` the last covered batch of each run."""

    number: int = 0
    parts: tuple[str, ...] = ()
    covered: Mapping[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, pattern: str) -> Iterator[str]:
    """Full names that match a pattern; none if there is no such folder."""
    files, place = _files(spark, pattern)
    for status in files.globStatus(place) or ():
        yield status.getPath().toString()


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.rsplit("/", 1)[1].removesuffix(".json")) for name in listed(spark, f"{path}/{_FOLDER}/*.json"))


def _read(spark: SparkSession, path: str, number: int) -> Manifest | None:
    files, place = _files(spark, f"{path}/{_FOLDER}/{number:010d}.json")
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None  # its writer was lost before it had written it
    return Manifest(number, tuple(found["parts"]), found["covered"])


def newest(spark: SparkSession, path: str) -> Manifest:
    """The last whole manifest; number 0 without parts where there is none."""
    for number in reversed(_numbers(spark, path)):
        found = _read(spark, path, number)
        if found is not None:
            return found
    return Manifest()


def commit(
    spark: SparkSession, path: str, after: Manifest, parts: tuple[str, ...], covered: Mapping[str, int] | None = None
) -> Manifest:
    """Make ``parts`` what counts, if ``after`` still is the last manifest; old manifests go."""
    if newest(spark, path).number != after.number:
        raise Conflict(f"{path} has changed since manifest {after.number}")
    known = _numbers(spark, path)
    number = max([0, *known]) + 1
    covered = dict(after.covered if covered is None else covered)
    files, place = _files(spark, f"{path}/{_FOLDER}/{number:010d}.json")
    try:
        stream = files.create(place, False)
    except Exception as error:  # the file is there: another writer was first
        raise Conflict(f"{path} has a manifest {number} already") from error
    try:
        stream.write(bytearray(json.dumps({"parts": list(parts), "covered": covered}).encode()))
    finally:
        stream.close()
    for old in known:
        if old < number - KEPT:
            remove(spark, f"{path}/{_FOLDER}/{old:010d}.json")
    return Manifest(number, tuple(parts), covered)
