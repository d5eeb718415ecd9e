"""Files by URI, for tasks that read ranges of them or write them whole: local ones and the stores that pyarrow knows."""

from __future__ import annotations

import re

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (or of a plain path) and the path in it."""
    if local := re.match(r"(?:file:(?://)?)?(/.*)", uri):
        return fs.LocalFileSystem(), local[1]
    return fs.FileSystem.from_uri(uri)


def known(uri: str) -> bool:
    """Whether pyarrow can open files there; Spark knows more stores than it does."""
    try:
        at(uri)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def listed(uri: str, *ends: str) -> list[fs.FileInfo]:
    """The files below a folder whose names end so, by path; none where there is no such folder."""
    store, path = at(uri)
    found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File and f.base_name.endswith(ends)), key=lambda f: f.path)
