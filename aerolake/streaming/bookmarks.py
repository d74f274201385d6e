"""Bookmarked delivery: files of a folder are handed to a job once.

A file-source checkpoint remembers which files belong to which batch; a ledger beside it has one entry for each
batch whose rows are staged.  The two are written in this order:

1. the stream logs the files of batch N (before it reads them);
2. ``stage(rows, run)`` puts them under the run ``<name>-<folder key>-N``; staging a run again replaces it;
3. the ledger entry N appears by a rename;
4. the stream commits batch N.

A job that dies after 1 or 2 replays the same files under the same run, so they are staged once; one that dies
after 3 skips the staged batch.  A run over unchanged folders has no batch at all.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolake.operators.incremental import exists, filesystem


class Bookmark:
    """The delivered files of one source folder, kept under ``<warehouse>/_bookmarks``."""

    def __init__(self, spark: SparkSession, warehouse: str, name: str, src: str) -> None:
        fs, path = filesystem(spark, src)
        self.key = hashlib.sha256(fs.makeQualified(path).toString().rstrip("/").encode()).hexdigest()[:12]
        self.spark, self.name = spark, name
        self.path = f"{warehouse.rstrip('/')}/_bookmarks/{name}-{self.key}"

    def run_of(self, batch_id: int) -> str:
        return f"{self.name}-{self.key}-{batch_id}"

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/ledger/{batch_id:012d}.json"

    def staged(self) -> dict[int, dict]:
        """What ``stage`` returned for each batch in the ledger."""
        fs, path = filesystem(self.spark, f"{self.path}/ledger")
        names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
        out = {}
        for name in sorted(n for n in names if n.endswith(".json") and not n.startswith(".")):
            stream = fs.open(path.suffix(f"/{name}"))
            try:
                out[int(name[:-5])] = json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        return out

    def _commit(self, batch_id: int, result: dict) -> None:
        fs, target = filesystem(self.spark, self._entry(batch_id))
        _, draft = filesystem(self.spark, f"{self.path}/ledger/.{batch_id:012d}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(result, default=str).encode()))
        finally:
            stream.close()
        if not fs.rename(draft, target):
            raise OSError(f"ledger entry {target} can't be written")

    def deliver(self, files: DataFrame, stage: Callable[[DataFrame, str], dict]) -> list[dict]:
        """Hand the rows of files not delivered before to ``stage``; its results for the batches of this call."""
        before = set(self.staged())

        def sink(rows: DataFrame, batch_id: int) -> None:
            if not exists(self.spark, self._entry(batch_id)):
                self._commit(batch_id, stage(rows, self.run_of(batch_id)))

        query = files.writeStream.option("checkpointLocation", f"{self.path}/files").foreachBatch(sink).trigger(availableNow=True).start()
        query.awaitTermination()
        return [result for batch, result in self.staged().items() if batch not in before]
