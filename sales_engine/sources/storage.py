"""Small files on whatever file system a path lies on: listings, and a log whose entries appear whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Storage:
    """Hadoop's file system below a folder; only names, sizes and small texts pass through the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def _at(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.conf)

    def exists(self, name: str = "") -> bool:
        path, system = self._at(name)
        return system.exists(path)

    def folders(self, pattern: str) -> list[str]:
        """Folders that fit a glob below the root, as paths relative to it, sorted."""
        path, system = self._at(pattern)
        found = system.globStatus(path) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in found if s.isDirectory())

    def files(self, name: str = "") -> list[tuple[str, int, int]]:
        """Path, size and time of every file below a folder, from the listing alone; or of the one file."""
        path, system = self._at(name)
        if not system.exists(path):
            return []
        waiting, out = [system.getFileStatus(path)], []
        while waiting:
            status = waiting.pop()
            if status.isDirectory():
                # unlike listFiles this asks nothing about a single file, which a writer may be renaming just now
                waiting += system.listStatus(status.getPath())
            else:
                out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(out)

    def read(self, name: str) -> str:
        path, system = self._at(name)
        stream = system.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file that isn't there yet, under another name first; False if some other writer was faster."""
        if self.exists(name):
            return False
        (path, system), (waiting, _) = self._at(name), self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = system.create(waiting, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.exists(name) and system.rename(waiting, path):
            return True
        system.delete(waiting, False)
        return False

    def delete(self, name: str) -> None:
        path, system = self._at(name)
        system.delete(path, True)


class CommitLog:
    """Numbered states of a folder, each a small JSON file; what the last one names is what readers see.

    A commit is one rename to the next number. Of two writers that start from one state only one can commit; where a
    store's rename isn't exclusive (plain object stores) let one writer at a time run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.storage = Storage(spark, root)

    def last(self) -> tuple[int, dict]:
        """The number and content of the last commit; 0 and nothing before the first."""
        names = [path.rsplit("/", 1)[-1] for path, _, _ in self.storage.files("_commits")]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(self.storage.read(f"_commits/{max(numbers):012d}.json"))

    def commit(self, after: int, state: dict) -> int:
        """Make this the state that follows number ``after``."""
        if not self.storage.put_new(f"_commits/{after + 1:012d}.json", json.dumps(state)):
            raise RuntimeError(f"commit {after + 1} under {self.storage.root} was made by another writer")
        return after + 1

    def tidy(self, pattern: str, named: list[str], commits: int = 100) -> None:
        """Delete folders ``<kind>-<number>-<id>`` that the last commit doesn't name and that can't be committed any more.

        A folder of the next number may be one that another writer is still filling. Of the commits the last ones stay.
        """
        number, _ = self.last()
        for path, _, _ in self.storage.files("_commits"):
            name = path.rsplit("/", 1)[-1]
            if name[:-5].isdigit() and int(name[:-5]) <= number - commits:
                self.storage.delete(f"_commits/{name}")
        for folder in self.storage.folders(pattern):
            if folder not in named and int(folder.split("-")[1]) <= number:
                self.storage.delete(folder)

    def folder(self) -> str:
        """The folder of the last commit, for logs whose states name one."""
        _, state = self.last()
        if "folder" not in state:
            raise FileNotFoundError(f"nothing is committed under {self.storage.root}")
        return f"{self.storage.root}/{state['folder']}"
