"""Small files next to the tables: version notes that only one writer can make.

Everything here is driver-side bookkeeping of a few names, through the Hadoop
file system that Spark reads and writes with.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def create(self, path: str, value: dict) -> bool:
        """Write a new file; False if there is one of the name. How strict this
        is follows from the file system: HDFS and object stores with
        conditional writes admit one of several writers."""
        system, place = self._at(path)
        try:
            out = system.create(place, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or system.exists(place):
                return False
            raise
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        return True

    def put(self, path: str, value: dict) -> None:
        """Write a file, in place of an older one."""
        system, place = self._at(path)
        out = system.create(place, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()

    def read(self, path: str) -> dict | None:
        """What the file says; None if there is none or it is not whole."""
        system, place = self._at(path)
        if not system.exists(place):
            return None
        source = system.open(place)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, place = self._at(folder)
        if not system.exists(place):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(place))

    def extent(self, folder: str) -> list[int] | None:
        """[files, bytes] below a folder, None if there is none."""
        system, place = self._at(folder)
        if not system.exists(place):
            return None
        summary = system.getContentSummary(place)
        return [summary.getFileCount(), summary.getLength()]

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)
