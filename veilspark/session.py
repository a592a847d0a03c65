"""Session construction and the shared folder for lineage cuts and scratch output."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from veilspark.storage import Files

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "veilspark",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with AQE on and the UI off; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One process, so that a folder of this machine is everyone's folder; local-cluster is a cluster."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local session without the setting gets
    a private temporary folder (tests); on a cluster a missing setting is
    an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="veilspark-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


SCRATCH, LEASE = "veilspark-scratch", "_lease"


class ScratchScope:
    """Owns what is written to the shared folder while it is open; closing it deletes that.

    ``with ScratchScope(spark):`` around a piece of work gives every ``scratch_path``
    taken inside a place in the scope's own folder. The folder holds a lease, which a
    thread of the driver renews while the scope is open; a driver that is killed lets
    it run out, and the next ``sweep`` removes the folder. Scopes nest. ``ttl``
    (seconds) must be far above the clocks' differences.
    """

    def __init__(self, spark: SparkSession, ttl: float = 3600.0):
        self.files, self.ttl = Files(spark), ttl
        self.root = f"{shared_dir(spark).rstrip('/')}/{SCRATCH}/scope-{uuid.uuid4().hex}"
        self._done = threading.Event()
        self._token = None

    def _renew(self) -> None:
        self.files.write_text(f"{self.root}/{LEASE}", str(time.time() + self.ttl))

    def _keep(self) -> None:
        while not self._done.wait(self.ttl / 3):
            self._renew()

    def __enter__(self) -> ScratchScope:
        self._renew()
        self._thread = threading.Thread(target=self._keep, daemon=True)
        self._thread.start()
        self._token = _scope.set(self)
        return self

    def __exit__(self, *_) -> None:
        _scope.reset(self._token)
        self._done.set()
        self._thread.join()
        self.files.delete(self.root)


_scope: ContextVar[ScratchScope | None] = ContextVar("veilspark_scope", default=None)


def current_scope() -> ScratchScope | None:
    return _scope.get()


def sweep(spark: SparkSession, unscoped_older_than: float | None = None) -> list[str]:
    """Deletes the folders of scopes whose lease has run out, and returns their names.

    With ``unscoped_older_than`` (seconds) also what was written outside of any scope
    and hasn't been touched for so long, such as results of queries.
    """
    files, root = Files(spark), f"{shared_dir(spark).rstrip('/')}/{SCRATCH}"
    gone = []
    for name in files.names(root):
        path = f"{root}/{name}"
        try:
            if name.startswith("scope-"):
                lease = f"{path}/{LEASE}"
                text = files.read_text(lease) if files.exists(lease) else ""
                # being created, or its lease being written anew: the folder's own age decides
                old = time.time() > float(text) if text else time.time() - files.modified(path) > 3600
            else:
                old = unscoped_older_than is not None and time.time() - files.modified(path) > unscoped_older_than
        except Py4JJavaError:  # closed in the meantime
            continue
        if old:
            files.delete(path)
            gone.append(name)
    return gone


def scratch_path(spark: SparkSession, name: str, scope: ScratchScope | None = None) -> str:
    """A fresh, unique path under the shared folder, in the open scope if there is one."""
    scope = scope or current_scope()
    base = scope.root if scope else f"{shared_dir(spark).rstrip('/')}/{SCRATCH}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def frozen(df: DataFrame, name: str, scope: ScratchScope | None = None) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage is cut, it doesn't
    change with its sources, and it goes with the scope that it was written in."""
    path = scratch_path(df.sparkSession, name, scope)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
