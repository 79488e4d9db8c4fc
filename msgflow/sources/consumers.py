"""Named consumers of a log: settings and acknowledged position, kept as two small JSON files."""

from __future__ import annotations

import re

from msgflow.sources import files


class ConsumerStore:
    def __init__(self, path: str, consumer: str):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", consumer):
            raise ValueError(f"Bad consumer name '{consumer}'")
        self.consumer = consumer
        self.folder = f"{path}/consumers/{consumer}"

    @classmethod
    def at(cls, folder: str) -> ConsumerStore:
        """The consumer kept in a folder."""
        path, consumer = folder.rsplit("/consumers/", 1)
        return cls(path, consumer)

    def exists(self) -> bool:
        return files.exists(f"{self.folder}/settings.json")

    def settings(self) -> dict:
        return files.read_json(f"{self.folder}/settings.json", {})

    def open(
        self,
        create: bool,
        ack_wait: int = 90,
        max_ack_pending: int = 1000,
        subjects: tuple[str, ...] = (),
        max_request_batch: int = 100,
    ) -> dict:
        """Create or update the consumer, or only attach to an existing one."""
        if create:
            wanted = {
                "ack_wait": ack_wait,
                "max_ack_pending": max_ack_pending,
                "subjects": list(subjects),
                "max_request_batch": max_request_batch,
            }
            if self.settings() != wanted:
                files.write_json(f"{self.folder}/settings.json", wanted)
            return wanted
        if not self.exists():
            raise ValueError(f"Consumer '{self.consumer}' does not exist and create_consumer is false")
        return self.settings()

    def floors(self) -> dict[str, int]:
        """Last acknowledged sequence number per stream below which nothing is open."""
        return files.read_json(f"{self.folder}/floors.json", {})

    def advance(self, floors: dict[str, int]) -> dict[str, int]:
        """Move the floors forward; they never move back."""
        merged = self.floors()
        for stream, seq in floors.items():
            merged[stream] = max(int(merged.get(stream, 0)), int(seq))
        files.write_json(f"{self.folder}/floors.json", merged)
        return merged

    def open_acks(self) -> list[str] | None:
        """Batches of acks that are not below the floors as a whole; None if nobody has kept the list."""
        return files.read_json(f"{self.folder}/open_acks.json")

    def keep_open_acks(self, batches: list[str]) -> None:
        files.write_json(f"{self.folder}/open_acks.json", sorted(set(batches)))
