"""Tables by key that are loaded at first use, held by Spark, and let go when a load fails."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class KeyedTables:
    """get(key) loads a table once, by ``load``, and keeps it in Spark's storage; others that ask meanwhile wait for that load.

    A load that fails is not kept: its storage is freed, the error goes to all who waited, and the next get tries again.  Blocks lost
    with an executor are computed anew from the table's lineage.  With ``most``, the table that was used longest ago goes first."""

    def __init__(self, load: Callable[[str], DataFrame], most: int | None = None, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> None:
        self.load, self.most, self.level = load, most, level
        self._held: dict[str, DataFrame] = {}  # in the order of use
        self._locks: dict[str, threading.Lock] = {}
        self._all = threading.Lock()

    def get(self, key: str) -> DataFrame:
        with self._all:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            with self._all:
                if key in self._held:
                    self._held[key] = self._held.pop(key)
                    return self._held[key]
            df = None
            try:
                df = self.load(key).persist(self.level)
                df.count()  # reads all of it, so what is broken shows here
            except Exception:
                if df is not None:
                    df.unpersist()
                raise
            with self._all:
                self._held[key] = df
                gone = [self._held.pop(k) for k in list(self._held)[: max(0, len(self._held) - self.most)]] if self.most else []
            for old in gone:
                old.unpersist()
            return df

    def drop(self, key: str) -> None:
        """Lets go of a table, if it is held."""
        with self._all:
            df = self._held.pop(key, None)
        if df is not None:
            df.unpersist()

    def held(self) -> list[str]:
        with self._all:
            return list(self._held)

    def close(self) -> None:
        for key in self.held():
            self.drop(key)

    def __enter__(self) -> KeyedTables:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def with_fallback(tables: KeyedTables, codes: dict[str, str], segment: str, pivot: str) -> DataFrame:
    """The table of a page's locale segment by its client code; unknown segments have the pivot's."""
    return tables.get(codes.get(segment, codes[pivot]))
