"""Names and small text files on the landing file system, through Spark's Hadoop client."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """File names, renames and texts of a few bytes; table data never passes through here."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._over, self._new_path = None, self._jvm.org.apache.hadoop.fs.Path  # looked up once: each part of the name is a call
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._new_path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(path) if s.isFile()]

    def tree(self, folder: str) -> list[str]:
        """Names of all files below a folder, relative to it."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        found, names = self._fs.listFiles(path, True), []
        head = self._fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
        while found.hasNext():
            names.append(found.next().getPath().toUri().getPath().removeprefix(head))
        return names

    def read_text(self, path: str) -> str | None:
        target = self._path(path)
        if not self._fs.exists(target):
            return None
        stream = self._fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace the file in one step: it is written aside and renamed over, so it is never half written.

        File systems that cannot rename over a file replace it when it is closed.
        """
        aside = f"{path}.writing"
        self._write(aside, text)
        try:
            context, over = self._renaming()
            context.rename(self._path(aside), self._path(path), over)
        except Py4JJavaError as error:
            if "UnsupportedFileSystemException" not in str(error.java_exception):
                raise
            self._write(path, text)
            self.delete(aside)

    def _renaming(self):
        """Hadoop's file context, which can rename over a file, and the option that tells it to."""
        if self._over is None:
            hadoop = self._jvm.org.apache.hadoop.fs
            over = self._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
            over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
            self._over = hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf), over
        return self._over

    def mark(self, path: str) -> None:
        """An empty file; that it exists is all it says."""
        self._write(path, "")

    def _write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()

    def write_text_once(self, path: str, text: str) -> None:
        """Write aside, then rename, so the file is either whole or absent."""
        aside = f"{path}.writing"
        self._write(aside, text)
        self.rename(aside, path)

    def rename(self, source: str, target: str) -> None:
        """Rename without ever replacing an existing file."""
        if self.exists(target):
            raise FileExistsError(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str, up_to: str | None = None) -> None:
        """Delete a file or folder, and folders above it that are empty then, below ``up_to``."""
        self._fs.delete(self._path(path), True)
        while up_to and (path := path.rsplit("/", 1)[0]).startswith(f"{up_to}/"):
            target = self._path(path)
            if self._fs.exists(target):
                if len(self._fs.listStatus(target)):
                    return
                self._fs.delete(target, False)
