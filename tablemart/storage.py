"""Shared folders for checkpoints and for tables written between two steps."""

import os
import re
import tempfile
from uuid import uuid4

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Compression of tables between two steps: hashes and ids take half the room that snappy leaves them.
BETWEEN = "zstd"


def shared_root(spark):
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine may leave it unset and gets a folder of its own. On a cluster a
    folder of this machine would not do, as executors would write to their own disks: it is refused.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="tablemart-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def shared_folder(spark, label):
    """A new, not yet existing path below the shared root."""
    return f"{shared_root(spark)}/tablemart/{label}-{uuid4().hex}"


def pin(frame):
    """Write the rows once to the reliable checkpoint folder and cut the lineage there."""
    spark = frame.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return frame.checkpoint(eager=True)


def via_table(frame, label):
    """Write the rows as Parquet in the shared folder and read them back."""
    path = shared_folder(frame.sparkSession, label)
    frame.write.mode("errorifexists").option("compression", BETWEEN).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# --- small files, through the file system of the path -----------------------------------


def _place(spark, path):
    java = spark.sparkContext._jvm
    where = java.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _link_once(path, text):
    """create_once on a mounted disk, where creating looks first and writes then, so that two writers
    could both succeed. A link is made or refused in one step, with the whole text behind it."""
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    handle, draft = tempfile.mkstemp(prefix=".", dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            out.write(text)
        os.chmod(draft, 0o644)
        os.link(draft, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def create_once(spark, path, text):
    """Create a small file unless it is there already; False means that another writer made it.

    The file system decides between two writers at once, so at most one of them gets True.
    """
    files, where = _place(spark, path)
    if files.getScheme() == "file":
        return _link_once(where.toUri().getPath(), text)
    try:
        stream = files.create(where, False)
    except Exception as error:
        # The file system names the reason; anything but an existing file is a failure of its own.
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def names_in(spark, path):
    """Names in a folder, sorted; none where the folder is missing."""
    files, where = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def read_text(spark, path):
    files, where = _place(spark, path)
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark, path):
    """Delete a file or a folder this library wrote."""
    files, where = _place(spark, path)
    files.delete(where, True)
