"""A sink of named files that appear together or not at all.

``df.write.format("named_files").mode("append").save(folder)`` writes a file for each row of
(name, content).  Every attempt of a task writes into a staging folder of its own; only when all tasks
are done does the driver list the files of the attempts that counted in a journal and rename them to
their place.  A task that fails or runs twice leaves one set of files, a job that fails leaves none,
and a driver that stops while renaming leaves a journal that ``finish`` carries out.

Defined results: a name that is there already is replaced; of equal names in one job the one of the
highest partition, and there of the last row, stays; null content is an empty file; a null or empty
name, or one that leaves the folder, fails the job; ``overwrite`` removes files that the job did not
write; an empty table writes none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Names of staging folders (Spark's readers pass over them) and of their journals.
STAGING, JOURNAL = "_staging-", "moves.json"


def locate(folder: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(folder)
    return store, root.rstrip("/")


def _there(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def _files(store: fs.FileSystem, root: str) -> set[str]:
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {f.base_name for f in found if f.type == fs.FileType.File}


def carry_out(store: fs.FileSystem, root: str, staging: str) -> None:
    """Rename what the journal of ``staging`` lists; what is renamed already is passed over."""
    with store.open_input_file(f"{staging}/{JOURNAL}") as f:
        plan = json.loads(f.read())
    for attempt, name in plan["moves"]:
        if _there(store, source := f"{staging}/{attempt}/{name}"):
            store.move(source, f"{root}/{name}")
    if plan["only"]:
        written = {name for _, name in plan["moves"]}
        for name in _files(store, root) - written:
            store.delete_file(f"{root}/{name}")
    store.delete_dir(staging)


def finish(folder: str) -> int:
    """Carry out the journals that stopped drivers left in ``folder``; the number of them."""
    store, root = locate(folder)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    left = sorted(f.path for f in found if f.base_name.startswith(STAGING) and _there(store, f"{f.path}/{JOURNAL}"))
    for staging in left:
        carry_out(store, root, staging)
    return len(left)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    attempt: str
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder, overwrite, uuid.uuid4().hex

    def write(self, rows):
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        store, root = locate(self.folder)
        target, names = f"{root}/{STAGING}{self.job}/{attempt}", {}
        for row in rows:
            if not row["name"] or "/" in row["name"] or row["name"].startswith("_"):
                raise ValueError(f"no file name: {row['name']!r}")
            if not names:
                store.create_dir(target, recursive=True)
            with store.open_output_stream(f"{target}/{row['name']}") as f:
                f.write((row["content"] or "").encode())
            names[row["name"]] = None
        return Written(context.partitionId(), attempt, list(names))

    def commit(self, messages):
        store, root = locate(self.folder)
        staging = f"{root}/{STAGING}{self.job}"
        done = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        last = {name: m.attempt for m in done for name in m.names}
        store.create_dir(staging, recursive=True)
        plan = json.dumps({"moves": [(attempt, name) for name, attempt in last.items()], "only": self.overwrite})
        with store.open_output_stream(f"{staging}/{JOURNAL}.tmp") as f:
            f.write(plan.encode())
        store.move(f"{staging}/{JOURNAL}.tmp", f"{staging}/{JOURNAL}")  # from here on the job counts
        carry_out(store, root, staging)

    def abort(self, messages):
        store, root = locate(self.folder)
        if _there(store, staging := f"{root}/{STAGING}{self.job}"):
            store.delete_dir(staging)


class NamedFiles(DataSource):
    """Format ``named_files``: option path, a folder with a URI that all executors reach."""

    @classmethod
    def name(cls):
        return "named_files"

    def schema(self):
        return "name string, content string"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], overwrite)


def write_named(df, folder: str, overwrite: bool = False) -> None:
    """Write (name, content) as files below ``folder``, after what a stopped driver left there."""
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(NamedFiles)
    finish(folder)
    df.select("name", "content").write.format("named_files").mode("overwrite" if overwrite else "append").save(folder)
