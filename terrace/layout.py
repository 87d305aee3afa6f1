"""One path contract shared by landing, gate, silver, gold and cold history."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str
    # Key buckets of the gold facts. Fixed for the life of a table: choose it so that one
    # bucket stays a few GB (64 suits about 0.3 TB, 16384 suits about 100 TB).
    fact_buckets: int = 64
    # Bronze files a run takes at a time; None takes all that are there.
    max_files_per_trigger: int | None = None
    # Move taken bronze files to ``archive``, one by one, so that the folder to list stays small.
    archive_taken: bool = False

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def history(self, name: str) -> str:
        return f"{self.root}/cold/silver/{name}_history"

    def snapshots(self, name: str) -> str:
        return f"{self.root}/cold/gold/{name}_snapshots"

    def admitted(self, name: str) -> str:
        """Lists of the bronze files that passed their gate; ingestion takes these."""
        return f"{self.root}/admitted/{name}"

    def archive(self, name: str) -> str:
        return f"{self.root}/archive/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def state(self, name: str) -> str:
        return f"{self.root}/state/{name}"
