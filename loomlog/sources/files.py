"""Paths: local ones are opened directly, others through pyarrow's file systems."""

from __future__ import annotations

import glob
import mmap
import os
from typing import BinaryIO
from urllib.parse import unquote, urlparse

SUFFIX = ".mlog"


def local(path: str) -> str | None:
    """The local path of a path or file: URI; None for other stores."""
    if path.startswith("file:"):
        return unquote(urlparse(path).path)
    return None if "://" in path else path


def _remote(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def expand(path: str) -> list[str]:
    """The recordings of a file, folder or pattern, in name order."""
    here = local(path)
    if here is None:
        from pyarrow import fs

        store, inner = _remote(path)
        info = store.get_file_info(inner)
        if info.type != fs.FileType.Directory:
            return [path]
        scheme = path.split("://", 1)[0]
        return sorted(f"{scheme}://{x.path.lstrip('/')}" for x in store.get_file_info(fs.FileSelector(inner)) if x.is_file and not x.base_name.startswith(("_", ".")))
    if os.path.isdir(here):
        return sorted(os.path.join(here, n) for n in os.listdir(here) if not n.startswith(("_", ".")) and os.path.isfile(os.path.join(here, n)))
    if os.path.exists(here):
        return [here]
    found = sorted(glob.glob(here))
    if not found:
        raise FileNotFoundError(path)
    return found


def side_files(path: str, prefix: str) -> list[str]:
    """Files of a local or mounted folder that begin with a prefix, in name order."""
    here = local(path)
    return sorted(os.path.join(here, n) for n in os.listdir(here) if n.startswith(prefix)) if here and os.path.isdir(here) else []


def sizes(paths: list[str]) -> dict[str, int]:
    """The sizes of files, of those that are still there."""
    out = {}
    for path in paths:
        here = local(path)
        try:
            if here is None:
                store, inner = _remote(path)
                size = store.get_file_info(inner).size
            else:
                size = os.path.getsize(here)
        except FileNotFoundError:
            size = None
        if size is not None:
            out[path] = size
    return out


def opened(path: str, mapped: bool = False) -> BinaryIO:
    """A file to read; with ``mapped`` a local one that isn't empty is mapped into memory."""
    here = local(path)
    if here is None:
        store, inner = _remote(path)
        return store.open_input_file(inner)
    data = open(here, "rb")
    if not mapped or not os.fstat(data.fileno()).st_size:
        return data
    with data:
        return mmap.mmap(data.fileno(), 0, access=mmap.ACCESS_READ)
