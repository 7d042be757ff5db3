"""Session helpers: the shared scratch folder and a local session for tests."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# what a Spark Connect session raises where a classic one has a SparkContext
_NO_CONTEXT = (PySparkAttributeError, PySparkNotImplementedError)


def _context(spark: SparkSession) -> SparkContext | None:
    """The SparkContext, or None on a Spark Connect client."""
    try:
        return spark.sparkContext
    except _NO_CONTEXT:
        return None


def shared_root(spark: SparkSession) -> str:
    """Folder on shared storage for scratch tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one set
    with ``setCheckpointDir``). Where neither is set, a local session gets a
    folder of its own, registered as checkpoint dir; any other master raises, as
    executors elsewhere would not see this machine's folders.
    """
    sc = _context(spark)
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stayledger-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def is_local(master: str) -> bool:
    """Whether the master runs everything in this one process."""
    return master == "local" or master.startswith("local[")


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", None) or str(id(spark))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as
    ``--py-files`` would: Python functions then find it wherever they run. On
    Spark Connect, or where the package is installed, nothing needs to be sent."""
    sc = _context(spark)
    if sc is None or sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="stayledger-code-"), "stayledger.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared root."""
    return f"{shared_root(spark)}/stayledger/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int = 8, app: str = "stayledger") -> SparkSession:
    """Session for tests and the bench: local mode, no UI, AQE on."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``, or None on Spark Connect.
    Errors of the file system itself (say, no permission) are not caught."""
    sc = _context(spark)
    if sc is None:
        return None
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, asked of the session's Hadoop file system.

    Returns None on Spark Connect, where it cannot be asked; callers then try
    the read and handle PATH_NOT_FOUND. Checking first avoids failed reads,
    which observation listeners log as errors.
    """
    found = _file_system(spark, path)
    return None if found is None else bool(found[0].exists(found[1]))


def list_dirs(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the sub-folders of ``path`` (empty when it does not exist),
    asked of the session's Hadoop file system; None on Spark Connect."""
    found = _file_system(spark, path)
    if found is None:
        return None
    fs, jpath = found
    if not fs.exists(jpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` (recursively) through the session's Hadoop file system.

    Used for staging folders once the commit that read them is written.
    Returns False on Spark Connect; the folder is then left behind, unreferenced."""
    found = _file_system(spark, path)
    return found is not None and bool(found[0].delete(found[1], True))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``, which must not exist, through the session's
    Hadoop file system. Raises where that is not possible."""
    found = _file_system(spark, source)
    if found is None:
        raise RuntimeError("folders cannot be renamed through Spark Connect")
    fs, path = found
    to = _file_system(spark, target)[1]
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(path, to):
        raise OSError(f"cannot rename {source} to {target}")


def sql_connection(spark: SparkSession, url: str, properties: dict):
    """A JDBC connection of the driver's JVM, by the driver class of ``properties`` where
    it names one (also one that Spark was started with)."""
    sc = _context(spark)
    if sc is None:
        raise RuntimeError("a JDBC copy needs a session with a SparkContext")
    jvm = sc._jvm
    settings = jvm.java.util.Properties()
    for k, v in properties.items():
        settings.setProperty(k, str(v))
    name = properties.get("driver")
    if not name:
        return jvm.java.sql.DriverManager.getConnection(url, settings)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = loader.loadClass(name).getDeclaredConstructor(sc._gateway.new_array(jvm.java.lang.Class, 0))
    return driver.newInstance(sc._gateway.new_array(jvm.java.lang.Object, 0)).connect(url, settings)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver's JVM collect garbage, which is how Spark's cleaner learns of
    shuffles and broadcasts that are no longer referred to. What the first collection
    finds may hold others, which a second one finds a moment later."""
    sc = _context(spark)
    if sc is not None:
        for _ in range(3):
            sc._jvm.System.gc()
            time.sleep(0.5)
