"""The log's manifests: one small Parquet file per committed batch, listing its data files.

A batch counts only once its manifest exists. The manifest names, per data file, the stream and the
sequence range in it, so offsets and scan plans come from metadata and no message is read for them.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from msgflow.sources import files

MANIFEST = pa.schema(
    [
        ("stream", pa.string()),
        ("file", pa.string()),
        ("first_seq", pa.int64()),
        ("last_seq", pa.int64()),
        ("rows", pa.int64()),
    ]
)


class LogIndex:
    """Manifests of one log; each is read once and kept."""

    def __init__(self, path: str):
        self.folder = f"{path}/commits"
        self._known: set[str] = set()
        self._entries = MANIFEST.empty_table()
        self._heads: dict[str, int] = {}

    def refresh(self) -> None:
        names = [n for n in files.list_names(self.folder) if n.endswith(".parquet") and not n.startswith("_")]
        fresh = [n for n in names if n not in self._known]
        if not fresh:
            return
        tables = [
            pq.read_table(io.BytesIO(files.read_bytes(f"{self.folder}/{n}")), schema=MANIFEST) for n in fresh
        ]
        added = pa.concat_tables(tables)
        self._entries = pa.concat_tables([self._entries, added]).combine_chunks()
        self._known.update(fresh)
        last = added.group_by("stream").aggregate([("last_seq", "max")])
        for stream, seq in zip(last["stream"].to_pylist(), last["last_seq_max"].to_pylist(), strict=True):
            self._heads[stream] = max(self._heads.get(stream, 0), seq)

    def batches(self) -> set[str]:
        """Ids of the finished batches seen at the last refresh."""
        return {name.removesuffix(".parquet") for name in self._known}

    def committed(self, batch: str) -> bool:
        return files.exists(f"{self.folder}/{batch}.parquet")

    def commit(self, batch: str, entries: pa.Table) -> None:
        buffer = io.BytesIO()
        pq.write_table(entries.select(MANIFEST.names).cast(MANIFEST), buffer)
        files.write_bytes(f"{self.folder}/{batch}.parquet", buffer.getvalue())

    def heads(self) -> dict[str, int]:
        """Last sequence number of every stream."""
        self.refresh()
        return dict(self._heads)

    def files(self, stream: str, after: int, upto: int) -> list[tuple[str, int, int, int]]:
        """Data files with messages of ``(after, upto]``: (file, first, last, rows), in sequence order."""
        return self.files_between({stream: after}, {stream: upto}).get(stream, [])

    def files_between(self, start: dict[str, int], end: dict[str, int]) -> dict[str, list[tuple[str, int, int, int]]]:
        """The same for the ranges ``(start, end]`` of any number of streams, in one pass over the manifests."""
        names = [s for s, upto in end.items() if upto > start.get(s, 0)]
        place = pc.index_in(self._entries["stream"], value_set=pa.array(names, pa.string()))
        place = place.fill_null(-1).to_numpy().astype(np.int64)
        known = np.flatnonzero(place >= 0)
        low, high = (np.array([bound.get(s, 0) for s in names], np.int64)[place[known]] for bound in (start, end))
        first, last = (self._entries[c].to_numpy()[known] for c in ("first_seq", "last_seq"))
        hit = known[(last > low) & (first <= high)]
        order = np.lexsort((self._entries["last_seq"].to_numpy()[hit], self._entries["first_seq"].to_numpy()[hit], place[hit]))
        chosen = self._entries.take(pa.array(hit[order]))
        out: dict[str, list[tuple[str, int, int, int]]] = {}
        for stream, *entry in zip(*[chosen[c].to_pylist() for c in ("stream", "file", "first_seq", "last_seq", "rows")]):
            out.setdefault(stream, []).append(tuple(entry))
        return out
