"""Small files in any store that Spark reaches: create once, publish by a rename, read, list.

Uses the Hadoop file system of the Spark driver, so a path means here what it
means to ``spark.read``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Names of the files in a folder below the root; none if it isn't there."""
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def claim(self, name: str) -> bool:
        """Creates an empty file; false if it is there already, however many try at once."""
        self._fs.mkdirs(self._path(name).getParent())
        return bool(self._fs.createNewFile(self._path(name)))

    def publish(self, name: str, text: str) -> None:
        """Writes a file that is seen as a whole or not at all."""
        draft = self._path(name + ".draft")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, self._path(name)):
            raise OSError(f"{self.root}/{name} could not be published")

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
