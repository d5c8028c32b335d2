"""Tables that survive a rewrite that fails.

The first version of a table is written in place, under the plain path of its name, where Spark's
own commit makes it visible. A rewrite goes to a new folder beside it, ``<path>.versions/<id>``, and
is published by one small file there, ``CURRENT.<number>``, which names it; readers follow the file
of the highest number. Until that file is there, readers see the old table, whole. A rewrite that
fails removes what it wrote, and what a killed process left behind is removed by the next rewrite
of that table. Several tables of a job are published together, after all of them have been written.

One writer per table at a time is assumed, as with any overwrite.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTER = "CURRENT."
ATTEMPTS = 5


class Files:
    """The few file operations needed, on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, folder: str) -> list[str]:
        system, place = self._at(folder)
        return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []

    def remove(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def text(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Write a small new file that readers find whole or not at all."""
        system, place = self._at(path)
        fresh = self.jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/_{uuid4().hex}")
        stream = system.create(fresh, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not system.rename(fresh, place):
            system.delete(fresh, False)
            raise FileExistsError(path)


def versions_of(path: str) -> str:
    return f"{path}.versions"


def pointers(files: Files, path: str) -> list[int]:
    """Numbers of the pointer files of the table at ``path``, in order."""
    names = files.names(versions_of(path))
    return sorted(int(name.removeprefix(POINTER)) for name in names if name.startswith(POINTER))


def current_path(spark: SparkSession, path: str) -> str:
    """Where the published version of the table at ``path`` is."""
    files = Files(spark)
    for attempt in range(ATTEMPTS):
        numbers = pointers(files, path)
        if not numbers:
            return path
        try:
            return f"{versions_of(path)}/{files.text(f'{versions_of(path)}/{POINTER}{numbers[-1]}').strip()}"
        except Py4JJavaError:
            # A newer version may have been published since the files were listed.
            if attempt == ATTEMPTS - 1 or pointers(files, path) == numbers:
                raise
    return path


class Rewrite:
    """Tables being rewritten, by path; nothing is visible before ``publish``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.files = spark, Files(spark)
        self.staged: dict[str, str] = {}

    def write(self, path: str, save: Callable[[str], None]) -> None:
        """Let ``save`` write the new version of the table at ``path`` to the place it is given."""
        fresh = not self.files.exists(path) and not pointers(self.files, path)
        place = path if fresh else f"{versions_of(path)}/{uuid4().hex}"
        self.staged[path] = place
        save(place)

    def path(self, path: str) -> str:
        """Where this rewrite's own version of a table is, or the published one."""
        return self.staged.get(path) or current_path(self.spark, path)

    def publish(self) -> None:
        renewed = {path: place.rsplit("/", 1)[1] for path, place in self.staged.items() if place != path}
        kept = {}
        for path, version in renewed.items():
            number = max(pointers(self.files, path), default=0) + 1
            self.files.create_text(f"{versions_of(path)}/{POINTER}{number}", version)
            kept[path] = {f"{POINTER}{number}", version}
        for path, names in kept.items():
            # Older pointers go before what they name.
            for name in sorted(self.files.names(versions_of(path)), key=lambda x: not x.startswith(POINTER)):
                if name not in names:
                    self.files.remove(f"{versions_of(path)}/{name}")
            self.files.remove(path)

    def discard(self) -> None:
        for path, place in self.staged.items():
            self.files.remove(place)
            if place != path and not self.files.names(versions_of(path)):
                self.files.remove(versions_of(path))


@contextmanager
def rewriting(spark: SparkSession) -> Iterator[Rewrite]:
    """Publish all tables that are written inside, or none if anything fails."""
    rewrite = Rewrite(spark)
    try:
        yield rewrite
    except BaseException:
        rewrite.discard()
        raise
    rewrite.publish()
