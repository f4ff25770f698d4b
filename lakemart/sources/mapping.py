"""Tables by name, the form in which every query takes its input."""

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame


class Sources(Mapping[str, DataFrame]):
    """Tables by name, opened only when a query asks for them."""

    def __init__(self, names: Sequence[str], scan: Callable[[str], DataFrame]):
        self._names = tuple(names)
        self._scan = scan

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(f"no table {name!r}, only {', '.join(self._names)}")
        return self._scan(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)
