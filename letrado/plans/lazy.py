"""A mapping whose values are built on first access.

Building a DataFrame runs Catalyst analysis on the driver; a query that needs
two silver entities should not pay for analysing all seven.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping


class LazyTables(Mapping):
    def __init__(self, factories: dict[str, Callable[[], object]]):
        self._factories = dict(factories)
        self._built: dict[str, object] = {}

    def __getitem__(self, key: str):
        if key not in self._built:
            self._built[key] = self._factories[key]()
        return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)
