"""A server of paged records for the queries: it answers from page files instead of a network."""

import json
import sys

import pyarrow.fs
from pyspark import cloudpickle

from cauce.sources.paged import PagedJson

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class StoredServer:
    """Answers like ``HttpPages`` from ``<path>/offset=<first record>/``, each a JSON array.

    All pages but the last one hold ``page_size`` records. The key of a record is its
    position from 1, in the field ``:id``. The folders are listed once: each bound of a
    read by key asks for the count.
    """

    def __init__(self, path, page_size):
        self.path = path
        self.page_size = page_size
        self.counted = None

    def _open(self):
        scheme, colon, rest = self.path.partition(":")
        if not colon or scheme == "file":
            return pyarrow.fs.LocalFileSystem(), "/" + (rest if colon else self.path).lstrip("/")
        uri = f"s3:{rest}" if scheme in ("s3a", "s3n") else self.path
        return pyarrow.fs.FileSystem.from_uri(uri)

    def _page(self, offset):
        files, root = self._open()
        folder = pyarrow.fs.FileSelector(f"{root}/offset={offset}", allow_not_found=True)
        records = []
        for info in sorted(files.get_file_info(folder), key=lambda i: i.path):
            if info.is_file and not info.base_name.startswith(("_", ".")):
                with files.open_input_stream(info.path) as stream:
                    records.extend(json.loads(stream.read()))
        return records

    def _records(self, offset, limit):
        start = offset - offset % self.page_size
        return self._page(start)[offset - start :][:limit]

    def count(self):
        if self.counted is None:
            files, root = self._open()
            folders = files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
            offsets = [int(i.base_name.removeprefix("offset=")) for i in folders if i.base_name.startswith("offset=")]
            self.counted = max(offsets) + len(self._page(max(offsets))) if offsets else 0
        return self.counted

    def fetch(self, offset, limit):
        return json.dumps(self._records(offset, limit))

    def next_key(self, after, step):
        key = (after or 0) + step
        return key if key <= self.count() else None

    def fetch_after(self, after, upto, limit):
        start = after or 0
        limit = limit if upto is None else min(limit, upto - start)
        found = self._records(start, limit) if limit > 0 else []
        return json.dumps([{":id": start + i + 1} | r for i, r in enumerate(found)])


class StoredPages(PagedJson):
    """Option ``path`` in place of ``url``."""

    @classmethod
    def name(cls):
        return "stored_pages"

    def pages(self, limit):
        return StoredServer(self.options["path"], limit)
