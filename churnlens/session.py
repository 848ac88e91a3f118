"""Spark session helpers.

Every job reads its settings from the active session. The only setting written here
is the checkpoint folder, and only when the cluster did not name one
(``spark.checkpoint.dir``) and the session runs in local mode (tests, bench).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "churnlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "12g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` (session conf or
    SparkContext); in local mode a scratch folder is created when none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (e.g. a Connect session has no SparkContext)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir()
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-ckpt-"))
        return sc.getCheckpointDir()
    if configured:
        return configured
    raise RuntimeError("spark.checkpoint.dir is not set; a remote session needs a shared folder")


#: Training rows of one task of a fit: below, a fit has fewer tasks; above this many a core,
#: it has more than one task a core.
ROWS_PER_FIT_TASK, ROWS_PER_CORE = 50_000, 250_000
#: Bytes and rows of input files that one task's rows come from. Bytes alone say little: files
#: that compress well hold ten times the rows.
INPUT_BYTES_PER_TASK, INPUT_ROWS_PER_TASK = 4 << 20, 200_000
_FILE_ROWS: dict = {}


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` is read from."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def input_rows(df: DataFrame) -> int:
    """Rows of the parquet files that ``df`` is read from, from their footers (counted once a
    session for the same files and size); files of other kinds count as none."""
    files = tuple(sorted(f for f in df.inputFiles() if f.endswith(".parquet")))
    if not files:
        return 0
    key = (id(df.sparkSession), files, input_bytes(df))
    if key not in _FILE_ROWS:
        # a file read by its name has no partition columns, so tables of any layout go together;
        # names are given as URIs, and the reader takes them for patterns
        names = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in files]
        _FILE_ROWS[key] = df.sparkSession.read.parquet(*names).count()
    return _FILE_ROWS[key]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over so many partitions that a task's share doesn't grow with
    the input: one for every ``INPUT_BYTES_PER_TASK`` and ``INPUT_ROWS_PER_TASK`` of its files.
    However many shuffle partitions the session has, the planner would join them again into
    one for every core, or 64 MB packed, so it is left to it for one task's share only."""
    conf, context = df.sparkSession.conf, df.sparkSession.sparkContext
    n = max(-(-input_bytes(df) // INPUT_BYTES_PER_TASK), -(-input_rows(df) // INPUT_ROWS_PER_TASK))
    least = min(int(conf.get("spark.sql.shuffle.partitions")), context.defaultParallelism)
    return df.repartition(max(n, least), *keys) if n > 1 else df


def stored_for_fits(df: DataFrame, rows_per_task: int = ROWS_PER_FIT_TASK) -> DataFrame:
    """``cut_lineage`` for rows that many fits read: in as few partitions as keep a task at
    ``rows_per_task`` rows. A tree learner runs two stages for every level of every round, so
    that on few rows each more partition costs more time than it saves. Many rows are dealt
    evenly, the same number of partitions to every core."""
    stored = cut_lineage(df)
    rows, cores = stored.count(), df.sparkSession.sparkContext.defaultParallelism  # row counts of the stored files
    wanted = -(-rows // rows_per_task)
    if wanted <= cores:
        return stored.coalesce(max(1, wanted))
    return cut_lineage(stored.repartition(cores * -(-rows // (cores * ROWS_PER_CORE))))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and continue
    from the re-read: one job (``Dataset.checkpoint`` on an un-persisted plan computes
    it twice), lineage cut so a lost executor never re-runs the upstream, and later
    scans get column pruning and filter pushdown."""
    spark = df.sparkSession
    path = checkpoint_dir(spark).rstrip("/") + "/churnlens-tables/" + uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
