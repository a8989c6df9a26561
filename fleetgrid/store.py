"""Folders and small files in the storage that the session uses, whatever it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """The file system that holds `folder`, which must be a path the session can open."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self.at(folder).getFileSystem(configuration)

    def at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._files.exists(self.at(path))

    def names(self, folder: str, folders: bool = True, files: bool = True) -> dict[str, float]:
        """What a folder holds, by name, with the time of its last change in seconds.

        Nothing if the folder is missing, also if it goes while it is listed."""
        if not self.exists(folder):
            return {}
        try:
            found = self._files.listStatus(self.at(folder))
        except Exception:
            if self.exists(folder):
                raise
            return {}
        return {
            x.getPath().getName(): x.getModificationTime() / 1000
            for x in found
            if (folders and x.isDirectory()) or (files and x.isFile())
        }

    def folders(self, folder: str) -> list[str]:
        return list(self.names(folder, files=False))

    def sizes(self, folder: str) -> dict[str, int]:
        """The files in a folder, by name, with their sizes in bytes."""
        found = self._files.listStatus(self.at(folder))
        return {x.getPath().getName(): x.getLen() for x in found if x.isFile()}

    def make(self, folder: str) -> None:
        """The folder and those above it, as far as they are missing."""
        self._files.mkdirs(self.at(folder))

    def create(self, path: str, lines: list[str] | None = None) -> None:
        """A new file, which appears whole or not at all: it is written beside its place and
        renamed. Fails if there is one already. An empty one is created at once."""
        if not lines:
            self._files.mkdirs(self.at(path).getParent())
            self._files.create(self.at(path), False).close()
            return
        hidden = f"{path}.tmp"
        stream = self._files.create(self.at(hidden), True)
        stream.write(bytearray("\n".join(lines).encode()))
        stream.close()
        if self.exists(path) or not self._files.rename(self.at(hidden), self.at(path)):
            raise OSError(f"could not create {path}")

    def lines(self, path: str) -> list[str]:
        stream = self._files.open(self.at(path))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return text.split("\n") if text else []

    def delete(self, path: str) -> None:
        self._files.delete(self.at(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self._files.rename(self.at(old), self.at(new)):
            raise OSError(f"could not rename {old}")
