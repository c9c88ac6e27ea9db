"""Small files of the store, through Spark's own file systems: any path that Spark reads will do."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Listing, reading, deleting and creating-if-absent below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        path = self.path(folder)
        if not self.fs.exists(path):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(path)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file whole or not at all; False if there is one of that name already.

        It is written aside and renamed without overwriting, as Spark's own checkpoints are.
        """
        aside, target = self.path(f"{name}.{uuid.uuid4().hex}.part"), self.path(name)
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.conf) if aside.toUri().getScheme() else None
        context = context or self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(aside, target, options)
        except Py4JJavaError as error:
            self.fs.delete(aside, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
