"""What tasks have done outside Spark, noted in the store's folder at once: a task that runs again reads its own notes.

A note is a small file named by a digest. Notes outlive the task, the executor and the job; the tables that are committed in
the end are made from what tasks return, so notes only have to last until then, and `forget` drops them.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs

from .enrich import Answer, conforms


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


class Journal:
    """Notes below a folder that all executors share (any address that pyarrow knows)."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _at(self, name: str) -> tuple[pafs.FileSystem, str]:
        local = self.root if "://" in self.root else "file://" + os.path.abspath(self.root.removeprefix("file:"))
        fs, base = pafs.FileSystem.from_uri(local)
        return fs, f"{base}/{name[:2]}/{name}"

    def get(self, name: str) -> dict | None:
        fs, path = self._at(name)
        if fs.get_file_info(f"{path}.json").type != pafs.FileType.File:
            return None
        with fs.open_input_stream(f"{path}.json") as f:
            return json.loads(f.read())

    def put(self, name: str, note: dict) -> None:
        """The note is whole or not there."""
        fs, path = self._at(name)
        fs.create_dir(os.path.dirname(path), recursive=True)
        temp = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(temp) as f:
            f.write(json.dumps(note, ensure_ascii=False).encode())
        fs.move(temp, f"{path}.json")

    def claim(self, name: str) -> bool:
        """True for the one attempt that finds itself alone; of two at once neither may be told so, and never both."""
        fs, path = self._at(name)
        fs.create_dir(f"{path}.claims", recursive=True)
        with fs.open_output_stream(f"{path}.claims/{uuid.uuid4().hex}") as f:
            f.write(b"1")
        return len(fs.get_file_info(pafs.FileSelector(f"{path}.claims"))) == 1

    def forget(self) -> None:
        fs, path = self._at("00")
        base = path.rsplit("/", 2)[0]
        if fs.get_file_info(base).type == pafs.FileType.Directory:
            fs.delete_dir(base)


class Remembered:
    """A client that never asks twice for the same: what conforms to its schema is noted before it is returned.

    An answer that this run has paid for is given back with its usage, as a retried task's rows are the only ones that count;
    one from an earlier run costs nothing.
    """

    def __init__(self, client: Callable[[str, str, str, dict], Answer], journal: Journal, run: str):
        self.client, self.journal, self.run = client, journal, run

    def __call__(self, task: str, system: str, user: str, schema: dict) -> Answer:
        name = digest(task, system, user, schema)
        if (note := self.journal.get(name)) is not None:
            return Answer(note["data"], note["usage"], note["tries"]) if note["run"] == self.run else Answer(note["data"], {}, 0)
        a = self.client(task, system, user, schema)
        if conforms(a.data, schema):
            self.journal.put(name, {"data": a.data, "usage": a.usage, "tries": a.tries, "run": self.run})
        return a


def once(sender: Callable[[str], dict], journal: Journal) -> Callable[[str, str], dict]:
    """A sender of (name, payload) that never sends a name twice.

    The attempt is claimed before it is made and its outcome noted after. A claim without an outcome (the worker died between
    the two, or still sends) is `unknown` and stays so: nobody can tell whether it arrived.
    """

    def send(name: str, payload: str) -> dict:
        if (note := journal.get(name)) is not None:
            return note
        if not journal.claim(name):
            return journal.get(name) or {"status": "unknown", "http_tries": 0, "response": None, "error": "an earlier attempt's outcome is unknown"}
        out = sender(payload)
        journal.put(name, out)
        return out

    return send
