"""Where the control tables lie."""

from __future__ import annotations

from dataclasses import dataclass

from lake_ingest.constants import RAW_PREFIX


@dataclass(frozen=True)
class Lake:
    """Control tables below one root folder that all executors share."""

    root: str
    incoming_bucket: str = "incoming"
    data_bucket: str = "lake"
    raw_prefix: str = RAW_PREFIX

    def _table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def proposals(self) -> str:
        return self._table("proposals")

    @property
    def raw(self) -> str:
        return self._table("raw_parts")

    @property
    def artifacts(self) -> str:
        return self._table("artifacts")

    @property
    def discovered(self) -> str:
        return self._table("discovered")

    @property
    def staged(self) -> str:
        return self._table("staged")

    @property
    def restored(self) -> str:
        return self._table("restored")

    @property
    def rejects(self) -> str:
        return self._table("rejects")

    @property
    def runs(self) -> str:
        return self._table("run_log")

    @property
    def state(self) -> str:
        return self._table("ingestion_state")
