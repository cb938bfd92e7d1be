"""An archive of packages behind HTTP as a Python data source.

Options: ``url``, ``ids`` (comma separated) or ``ids_path`` (a text file of
ids), ``page`` (ids per partition), ``transport`` (``module:function`` called as
``f(url, headers)`` giving bytes or raising), ``tags`` and ``genre`` for a
search by ``search`` (``module:function``, called with what all results must
have, giving their ids one after the other), ``user``/``password``, which are
never printed, or ``login_file``, a flat YAML file of ``url``, ``user`` and
``password``.
"""

from __future__ import annotations

import base64
import importlib
import json
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.schema import PACKAGE

#: Connect and read retries, redirects, and back-off in seconds.
CONNECT, READ, REDIRECT, BACKOFF = 5, 4, 5, 0.02


#: Errors in a row after which a search is given up.
MAX_ERRORS = 20
_pool = None


class Ids(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


def _load(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def http_get(url: str, headers: dict[str, str]) -> bytes:
    """GET with retries; the body of a successful answer."""
    global _pool
    import urllib3

    if _pool is None:  # one per process, whose connections stay open
        _pool = urllib3.PoolManager(retries=urllib3.Retry(connect=CONNECT, read=READ, redirect=REDIRECT, backoff_factor=BACKOFF))
    answer = _pool.request("GET", url, headers=headers)
    if answer.status >= 400:
        raise OSError(f"status {answer.status}")
    return answer.data


def metadata(package_id: str, found: dict | None) -> dict:
    """The six fields with what stands in for missing ones; all failed without an answer."""
    if found is None:
        return dict.fromkeys(("title", "created", "edition", "issue"), "failed") | {"package_id": package_id, "year": -1}
    try:
        year = int(found.get("year", -1))
    except (TypeError, ValueError):
        year = -1
    rest = {f: str(found.get(f, f"no {f}")) for f in ("title", "created", "edition", "issue")}
    return rest | {"package_id": package_id, "year": year}


def contents(found: list | None) -> list[str | None]:
    """The content of each box; lists of strings joined by spaces."""
    out = []
    for box in found or []:
        text = box.get("content")
        out.append(" ".join(x for x in text if x is not None) if isinstance(text, list) else text)
    return out


def read_login(path: str) -> dict[str, str]:
    """The entries of a flat YAML file: ``key: value`` lines, quotes and comments allowed."""
    found = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            m = re.match(r"""\s*([\w.-]+)\s*:\s*(?:"([^"]*)"|'([^']*)'|(.*?))\s*(?:\s#.*)?$""", line)
            if m and not line.lstrip().startswith("#"):
                found[m[1]] = next((g for g in m.groups()[1:] if g is not None), "")
    return found


def drained(keys) -> Iterator[str]:
    """Ids of a search until it ends or gives an empty one; errors of the connection are passed over, up to a bound in a row."""
    keys, errors = iter(keys), 0
    while True:
        try:
            found = next(keys)
        except StopIteration:
            return
        except Exception as e:
            if not (isinstance(e, OSError) or type(e).__name__ == "ProtocolError"):
                raise
            errors += 1
            if errors > MAX_ERRORS:
                raise
            continue
        errors = 0
        if not found:
            return
        yield found


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "login_file" in options:
            options = read_login(options["login_file"]) | {k: v for k, v in options.items() if k != "login_file"}
        self.options = options

    def ids(self) -> list[str]:
        if "search" in self.options:
            names = {"tags": "tags", "genre": "meta.genre"}
            wanted = {name: self.options[k] for k, name in names.items() if k in self.options}
            return list(drained(_load(self.options["search"])(wanted)))
        if "ids_path" in self.options:
            with open(self.options["ids_path"], encoding="utf-8") as f:
                return [line.strip() for line in f if line.strip()]
        return [i for i in self.options.get("ids", "").split(",") if i]

    def partitions(self) -> list[Ids]:
        ids, page = self.ids(), int(self.options.get("page", 10_000))
        return [Ids(ids[k : k + page]) for k in range(0, len(ids), page)] or [Ids([])]

    def get(self, package_id: str, name: str):
        headers = {}
        if "user" in self.options:
            secret = f"{self.options['user']}:{self.options.get('password', '')}".encode()
            headers["Authorization"] = "Basic " + base64.b64encode(secret).decode()
        fetch = _load(self.options.get("transport", "corpusloom.sources.archive:http_get"))
        try:
            return json.loads(fetch(f"{self.options['url']}{package_id}/{name}", headers))
        except Exception:  # any failure counts as a missing file
            return None

    def read(self, partition: Ids) -> Iterator[tuple]:
        for package_id in partition.ids:
            meta = metadata(package_id, self.get(package_id, "meta.json"))
            if meta["title"] != "failed":
                order = ("package_id", "title", "created", "year", "edition", "issue")
                yield tuple(meta[f] for f in order), contents(self.get(package_id, "content.json"))


class ArchiveSource(DataSource):
    """``spark.dataSource.register(ArchiveSource)``, then ``spark.read.format("archive")``."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return PACKAGE

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def download(spark, path: str, **options: str) -> None:
    """Append the packages of an archive to JSON lines under ``path``, in a folder per year; those without metadata are left out."""
    from corpusloom.sources.sinks import write_packages

    spark.dataSource.register(ArchiveSource)
    write_packages(spark.read.format("archive").options(**options).load(), path, by_year=True)
