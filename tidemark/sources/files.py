"""Small-file helpers over the Hadoop file system of a path (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few file-system calls the table store needs; only metadata passes through here."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder; 0 if there is none."""
        fs, target = self._at(path)
        return fs.getContentSummary(target).getLength() if fs.exists(target) else 0

    def parsed_size(self, text: str) -> int:
        """Bytes of a size as Spark writes it, such as ``64MB``."""
        return self._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)

    def written_schema(self, folder: str) -> str | None:
        """The schema, as JSON, that Spark noted in the footer of a folder's Parquet file; None without a folder, a file or a note. No job runs."""
        files = [name for name in self.names(folder) if name.startswith("part-")]
        if not files:
            return None
        hadoop = self._jvm.org.apache.parquet.hadoop
        _, target = self._at(f"{folder}/{files[0]}")
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(target, self._conf))
        try:
            return reader.getFileMetaData().getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
        finally:
            reader.close()

    def touch(self, path: str) -> None:
        fs, target = self._at(path)
        fs.create(target).close()

    def replace(self, source: str, path: str) -> None:
        """Put a written folder in the place of another one."""
        fs, target = self._at(path)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(self._jvm.org.apache.hadoop.fs.Path(source), target):
            raise OSError(f"{source} could not be put in the place of {path}")

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)
