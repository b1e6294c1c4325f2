"""What paid calls gave, kept by key before it is used.

Spark repeats a task whose executor was lost, and with it the calls that the task
had made. A ledger has a file for each call, named by a hash of what was asked, in
a folder that all executors reach; a repeated call reads it. Files are written
beside their place and renamed, so that one is never half there. Workers write
them by themselves, so the folder has to be one that pyarrow reaches: a mounted
one, hdfs: or s3: (s3a: is read as such).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from typing import Any


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri("s3:" + uri[4:] if uri.startswith("s3a:") else uri)


class Ledger:
    """Answers of calls in the folder ``uri``; an unknown store is an error here, not in a task."""

    def __init__(self, uri: str):
        system, folder = _opened(uri)
        system.create_dir(folder, recursive=True)
        self.uri = uri.rstrip("/")

    @staticmethod
    def key(asked: Sequence[Any]) -> str:
        return hashlib.sha256(json.dumps(list(asked), ensure_ascii=False, sort_keys=True, default=str).encode()).hexdigest()

    def once(self, asked: Sequence[Any], call: Callable[[], Any]) -> Any:
        """The answer that is kept for what was asked, else that of the call, which is kept first. An answer is a JSON value; a call that fails leaves none."""
        from pyarrow import fs

        system, folder = _opened(self.uri)
        key = self.key(asked)
        path = f"{folder}/{key[:2]}/{key}.json"
        if system.get_file_info(path).type == fs.FileType.File:
            with system.open_input_stream(path) as f:
                return json.loads(f.read().decode())
        answer = call()
        system.create_dir(f"{folder}/{key[:2]}", recursive=True)
        draft = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as f:
            f.write(json.dumps(answer, ensure_ascii=False).encode())
        system.move(draft, path)
        return answer
