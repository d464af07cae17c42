"""Files and folders next to the data, on any file system that Spark can write.

Spark's DataFrame writer can neither list nor delete folders, nor create a file only if it is
not there. The Hadoop file system that it uses itself can, so this module reaches through the
driver's JVM, and nothing else in the library does.
"""

from pyspark.sql import SparkSession


class Folder:
    """One folder; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path
        at = self._path("")
        self._files = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """What the folder holds; nothing if it is not there."""
        if not self._files.exists(self._path("")):
            return []
        return [found.getPath().getName() for found in self._files.listStatus(self._path(""))]

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of that name."""
        if self._files.exists(self._path(name)):
            return False
        try:
            out = self._files.create(self._path(name), False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "already exists" in str(error):
                return False
            raise
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        return True

    def read(self, name: str) -> str | None:
        """The text of a file, None if it is gone."""
        if not self._files.exists(self._path(name)):
            return None
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def size(self, name: str) -> int:
        return self._files.getContentSummary(self._path(name)).getLength()

    def changed(self, name: str) -> float:
        """When a folder was last changed, in seconds of the epoch."""
        return self._files.getFileStatus(self._path(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self._files.delete(self._path(name), True)
