"""Files of the cluster's storage through Hadoop's file system API (metadata work on the driver)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Any store that the session can reach; paths with or without a scheme."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        """The file, or the folder with all that is in it; nothing if it isn't there."""
        fs, p = self._at(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        """Entries of a folder; none if it isn't there."""
        fs, p = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def modified(self, path: str) -> float:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getModificationTime() / 1000

    def data_files(self, path: str) -> list[str]:
        """Files below a folder, as paths relative to it, without those whose names mark them as hidden."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        root, found, it = fs.makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
        while it.hasNext():
            name = it.next().getPath().toString()[len(root) + 1:]
            if not any(part[:1] in "_." and "=" not in part for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        """Renames a file; a target that is there already stays, and the source then raises."""
        fs, p = self._at(source)
        _, q = self._at(target)
        fs.mkdirs(q.getParent())
        if fs.exists(q) or not fs.rename(p, q):
            raise FileExistsError(f"cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        n = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(n)).decode()
        finally:
            stream.close()
