"""Small files and renames through the session's own file systems (Hadoop's), for pointers and ledgers.

Only names, sizes and a few lines of JSON pass through the driver; table data stays with Spark.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that a path lies in."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = self._path(path)
        self._fs = root.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.makeQualified(root).toUri(), conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def files_below(self, path: str) -> list[tuple[str, int, int]]:
        """``(path below it, bytes, modification time)`` of each visible file under a folder."""
        out, base = [], self._path(path)
        if not self._fs.exists(base):
            return out
        base = self._fs.makeQualified(base)
        it = self._fs.listFiles(base, True)
        while it.hasNext():
            status = it.next()
            below = status.getPath().toString()[len(base.toString()) + 1:]
            if not any(p[:1] in "_." and "=" not in p for p in below.split("/")):
                out.append((below, status.getLen(), status.getModificationTime()))
        return sorted(out)

    def read(self, path: str) -> dict | None:
        """The JSON of a small file; None if there is none."""
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, path: str, content: dict, replace: bool = True) -> bool:
        """Put a small file in place by a rename: readers see the old content or the new.

        With ``replace=False`` an existing file stays, and the result is False.
        """
        target = self._path(path)
        self._fs.mkdirs(target.getParent())
        draft = self._path(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(json.dumps(content, sort_keys=True).encode())
        finally:
            stream.close()
        try:
            self._rename(draft, target, replace)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if not replace and self._fs.exists(target):
                return False
            raise e
        return True

    def move(self, source: str, target: str) -> None:
        """Rename a file into a folder that may not be there yet; a target that is there already wins."""
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.exists(to):
            self._rename(self._path(source), to, False)

    def _rename(self, source, target, replace: bool) -> None:
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE if replace else kind.NONE
        self._context.rename(source, target, options)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
