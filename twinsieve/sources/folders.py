"""Files and folders of any store that the session can reach, by the store's own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """Small files and names; the data itself goes through Spark's readers and writers."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def exists(self, path: str) -> bool:
        files, target = self._files(path)
        return files.exists(target)

    def delete(self, path: str) -> None:
        files, target = self._files(path)
        files.delete(target, True)

    def names(self, path: str) -> dict[str, int]:
        """The names in a folder with the times they were changed, in milliseconds."""
        files, target = self._files(path)
        if not files.exists(target):
            return {}
        found = files.listStatus(target)
        return {f.getPath().getName(): f.getModificationTime() for f in found}

    def read(self, path: str) -> str:
        files, target = self._files(path)
        stream = files.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Make a file in one step, with all of its text; false if there is one of that name.

        The text is written beside it and renamed, so a reader sees the whole file or none.
        """
        files, target = self._files(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(
            target.getParent(), f".{target.getName()}-{self._jvm.java.util.UUID.randomUUID()}"
        )
        stream = files.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self._conf
        )
        # Without the option to overwrite, the rename fails if the name is taken.
        rename = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(beside, target, rename)
        except Exception as error:
            files.delete(beside, False)
            if files.exists(target):
                return False
            raise error
        return True

    def _files(self, path: str) -> tuple[object, object]:
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target
