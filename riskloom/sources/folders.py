"""Names, times and moves of the files in a folder, through the file system that Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def times(self, name: str = "") -> dict[str, int]:
        """Time of change, in milliseconds, of each file that Spark's readers see."""
        if not self.has(name):
            return {}
        found = self._files.listStatus(self._at(name))
        files = {f.getPath().getName(): f.getModificationTime() for f in found if f.isFile()}
        return {file: at for file, at in files.items() if not file.startswith(("_", "."))}

    def mark(self, name: str) -> None:
        """Makes an empty file."""
        self._files.create(self._at(name), True).close()

    def set_time(self, name: str, millis: int) -> None:
        self._files.setTimes(self._at(name), millis, -1)

    def move(self, name: str, target: str) -> None:
        if not self._files.rename(self._at(name), self._at(target)):
            raise OSError(f"{self.path}/{name} cannot be moved to {self.path}/{target}")

    def remove(self, name: str = "") -> None:
        self._files.delete(self._at(name), True)
