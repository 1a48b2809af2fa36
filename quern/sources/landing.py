"""Landing of remote files on the driver: atomic, checked, and only when they changed."""

from __future__ import annotations

import hashlib
import os
import zipfile
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.error import HTTPError
from urllib.request import Request, urlopen

from quern.sources.readers import Pacer

CHUNK = 1 << 20


@dataclass(frozen=True)
class Landed:
    path: str
    sha256: str
    size_bytes: int
    changed: bool


def land(url: str, path: str, previous: str | None = None, agent: str = "quern", archive: bool = False, pacer: Pacer | None = None) -> Landed:
    """Fetches a file beside its place and moves it there when it is whole; an archive must open. Unchanged content is not replaced."""
    if pacer:
        pacer.wait()
    part, digest, size = path + ".part", hashlib.sha256(), 0
    try:
        with urlopen(Request(url, headers={"User-Agent": agent}), timeout=600) as answer, open(part, "wb") as out:
            while block := answer.read(CHUNK):
                digest.update(block)
                size += len(block)
                out.write(block)
        if archive and not zipfile.is_zipfile(part):
            raise ValueError(f"{url} is not a ZIP archive")
        now = digest.hexdigest()
        if now == previous and os.path.exists(path):
            return Landed(path, now, size, False)
        os.replace(part, path)
        return Landed(path, now, size, True)
    finally:
        if os.path.exists(part):
            os.remove(part)


def bulk_or_each(bulk: Callable[[], str], each: Callable[[str], str], keys: Iterable[str]) -> list[str]:
    """The bulk archive; only if the service forbids it (403), one request for each key. Other errors are not covered up."""
    try:
        return [bulk()]
    except HTTPError as e:
        if e.code != 403:
            raise
    return [each(k) for k in keys]


def safe_path(root: str, relative: str) -> str:
    """A path under the root; one that leads out of it, or through a link, is refused."""
    full = os.path.realpath(os.path.join(root, relative))
    if os.path.commonpath([os.path.realpath(root), full]) != os.path.realpath(root) or os.path.islink(os.path.join(root, relative)):
        raise ValueError(f"{relative} leads out of {root}")
    return full
