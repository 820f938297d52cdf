"""Small driver-side calls on the cluster's file system (metadata only)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def aside(path: str) -> str:
    """An unused name beside ``path`` that readers of the folder pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{uuid.uuid4().hex}-{name}"


class ClusterFiles:
    """Hadoop FileSystem access for any scheme Spark itself can read."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        jpath = self._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self._conf), jpath

    def qualified(self, path: str) -> str:
        """The path with its scheme, for code that runs outside Hadoop."""
        fs, jpath = self._open(path)
        return fs.makeQualified(jpath).toString()

    def exists(self, path: str) -> bool:
        fs, jpath = self._open(path)
        return fs.exists(jpath)

    def names(self, path: str) -> list[str]:
        """Names of the direct children, or nothing when the path is absent."""
        fs, jpath = self._open(path)
        if not fs.exists(jpath):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(jpath))

    def glob(self, pattern: str) -> list[str]:
        fs, jpath = self._open(pattern)
        found = fs.globStatus(jpath)
        return sorted(s.getPath().toString() for s in found) if found else []

    def read_text(self, path: str) -> str:
        fs, jpath = self._open(path)
        stream = fs.open(jpath)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> bool:
        """Publish a small file in one rename; False when it already exists."""
        fs, jpath = self._open(path)
        if fs.exists(jpath):
            return False
        staged = self._jvm.org.apache.hadoop.fs.Path(
            jpath.getParent(), f".{jpath.getName()}-{uuid.uuid4().hex}")
        stream = fs.create(staged, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if fs.getUri().getScheme() != "file":
            return fs.rename(staged, jpath)  # refused where the name is taken
        # A local rename replaces; a hard link fails where the name is taken.
        nio = self._jvm.java.nio.file
        local = [self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (jpath, staged)]
        try:
            nio.Files.createLink(*local)
            return True
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            return False
        finally:
            fs.delete(staged, False)

    def swap(self, fresh: str, path: str) -> None:
        """Put ``fresh`` in the place of ``path``; what was there is removed last."""
        fs, jpath = self._open(path)
        old = self._open(f"{aside(path)}")[1]
        if not fs.rename(jpath, old):
            raise OSError(f"{path} cannot be moved aside")
        if not fs.rename(self._open(fresh)[1], jpath):
            fs.rename(old, jpath)
            raise OSError(f"{fresh} cannot take the place of {path}")
        fs.delete(old, True)

    def remove(self, path: str) -> None:
        fs, jpath = self._open(path)
        fs.delete(jpath, True)
