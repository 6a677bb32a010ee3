"""Small file-system calls through Hadoop, so that any path Spark can read works here too."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A directory on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Child names, without hidden ones."""
        if not self.exists(name):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(name))]
        return sorted(n for n in found if not n.startswith((".", "_tmp-")))

    def matching(self, pattern: str) -> list[str]:
        """Paths below the folder that match a glob, relative to it, in one listing call."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in found)

    def size(self, name: str = "") -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._at(name)).getLength() if self.exists(name) else 0

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file that readers see whole or not at all; an existing one is an error."""
        parent = name.rpartition("/")[0]
        temporary = f"{parent}/_tmp-{uuid.uuid4().hex}" if parent else f"_tmp-{uuid.uuid4().hex}"
        self._fs.mkdirs(self._at(parent))
        stream = self._fs.create(self._at(temporary), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        if self.exists(name) or not self._fs.rename(self._at(temporary), self._at(name)):
            self._fs.delete(self._at(temporary), False)
            raise FileExistsError(f"{self.path}/{name} was published by another writer")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
