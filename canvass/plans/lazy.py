"""Tables by name, each planned when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """Table names with the functions that plan them; a form with many tables costs only the plans that are used."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self.makers = dict(makers)
        self.known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.known:
            self.known[name] = self.makers[name]()
        return self.known[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)

    def replaced(self, name: str, make: Callable[[], DataFrame]) -> LazyTables:
        """The same tables, one of them planned in another way."""
        others = {n: (lambda n=n: self[n]) for n in self.makers}
        return LazyTables(others | {name: make})
