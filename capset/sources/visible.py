"""Commit by a list: tasks write files under names that are never used again, the driver publishes one list of them last.

Nothing is renamed or copied.  Files that no list names (of lost or failed attempts, of a run under way) are invisible to
readers that ask ``visible_files``; in a folder without any list all files are visible, as those from elsewhere.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid

PREFIX = "_visible-"


def _lists(filesystem, root: str) -> list[str]:
    from pyarrow import fs as pafs

    infos = filesystem.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True))
    return sorted(i.path for i in infos if posixpath.basename(i.path).startswith(PREFIX) and i.path.endswith(".json"))


def publish(filesystem, root: str, names: list[str], replaces: bool) -> str:
    """Make the files ``names`` (relative to ``root``) visible; with ``replaces`` those of earlier lists no more."""
    filesystem.create_dir(root, recursive=True)
    name = f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
    tmp = posixpath.join(root, f".{name}.tmp")
    with filesystem.open_output_stream(tmp) as out:
        out.write(json.dumps({"replaces": replaces, "files": sorted(names)}).encode())
    filesystem.move(tmp, posixpath.join(root, name))  # the one small file that is moved, so it appears whole
    return name


def visible_files(filesystem, root: str) -> list[str] | None:
    """Paths of the published files, in name order; None where nothing was published."""
    lists = _lists(filesystem, root)
    if not lists:
        return None
    files: list[str] = []
    for path in lists:
        with filesystem.open_input_stream(path) as f:
            entry = json.loads(f.read())
        files = entry["files"] if entry["replaces"] else files + entry["files"]
    return sorted(posixpath.join(root, n) for n in files)
