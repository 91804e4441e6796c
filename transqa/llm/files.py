"""Files of our own formats below a folder that all executors share, through pyarrow.

A task writes under a name of its own, and the folder's manifest, written last by the
driver, lists the files of the tasks that succeeded: the leftovers of lost executors and
repeated tasks are never read.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs

MANIFEST = "_manifest.json"


def store(place: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(place)


def new_name(suffix: str) -> str:
    from pyspark import TaskContext

    task = TaskContext.get()
    part = task.partitionId() if task else 0
    return f"part-{part:07d}-{uuid.uuid4().hex[:12]}{suffix}"


def write_manifest(place: str, content: dict) -> None:
    system, root = store(place)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps(content).encode())


def read_manifest(place: str) -> dict | None:
    system, root = store(place)
    name = f"{root}/{MANIFEST}"
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(name) as found:
        return json.loads(found.read())
