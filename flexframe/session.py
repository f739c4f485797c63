"""Session helpers: a tuned local session for tests and a shared scratch folder.

Scratch output (staged relationalize tables, round-trip writes, bookmark
ledgers) must live where every executor can read it, so it is placed under the
cluster's ``spark.checkpoint.dir``. Only when that setting is missing (local
tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flexframe") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="flexframe-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables; the same one in every application.

    It is ``spark.checkpoint.dir`` itself, not the folder below it that Spark
    makes anew for each application. Where the setting is missing, a folder
    given to ``setCheckpointDir`` serves, and in local mode a temporary one;
    on a cluster without either this raises, since no other folder is shared.
    """
    sc = _context(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and sc is not None:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() if sc is not None else None
    if conf:
        if sc is not None and not current:
            sc.setCheckpointDir(conf)
        return conf
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]  # without the application's own folder
    if sc is None or not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="flexframe-ckpt-")
    sc.setCheckpointDir(made)
    return made


_MADE: list[str] = []


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/flexframe-{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Removes the folders that ``scratch_dir`` made in this process; how many there were.

    For the end of a job: frames that aren't written yet read from them.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flexframe`` importable in Python workers (once per application).

    Functions run by ``mapInArrow`` / ``mapInPandas`` refer to this package,
    so executors need it, as with ``--py-files``. The package is zipped next to
    the shared checkpoint folder when that is local, else in a driver temp
    folder; ``addPyFile`` then distributes it through Spark's file server.
    """
    import zipfile

    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else (base if "://" not in base else None)
    folder = os.path.join(local, f"flexframe-pyfiles-{uuid.uuid4().hex}") if local else tempfile.mkdtemp(prefix="flexframe-pyfiles-")
    os.makedirs(folder, exist_ok=True)
    zip_path = os.path.join(folder, "flexframe.zip")
    with zipfile.ZipFile(zip_path, "w") as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    if sc is not None:
        sc.addPyFile(zip_path)
    else:
        spark.addArtifacts(zip_path, pyfile=True)
    _SHIPPED.add(app)
