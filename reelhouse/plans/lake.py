"""Layout of the lake's folders."""

from __future__ import annotations

from dataclasses import dataclass

from reelhouse import schemas


@dataclass(frozen=True)
class Lake:
    """Folders below one base that every executor can reach."""

    base: str

    # Folder names.
    @property
    def titles(self) -> str:
        return f"{self.base}/{schemas.TITLES_TOPIC}"

    @property
    def credits(self) -> str:
        return f"{self.base}/{schemas.CREDITS_TOPIC}"

    @property
    def titles_checkpoint(self) -> str:
        return f"{self.base}/checkpoints/titles"

    @property
    def credits_checkpoint(self) -> str:
        return f"{self.base}/checkpoints/credits"

    def rejects(self, topic: str) -> str:
        return f"{self.base}/rejects/{topic}"

    def rejects_checkpoint(self, topic: str) -> str:
        return f"{self.base}/checkpoints/rejects/{topic}"

    @property
    def snapshots(self) -> str:
        return f"{self.base}/curated/snapshots"
