"""Column roles of a table to be ranked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

HOUR = "created_hour"
WEEKDAY = "created_day_of_week"
ROW_NUMBER = "source_row_number"


class DataContractError(ValueError):
    """The data breaks the column contract."""


@dataclass(frozen=True)
class TableSpec:
    """Which column plays which role; every operator takes its columns from here."""

    id: str
    time: str
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    binary: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    questionable: tuple[str, ...] = ()
    source_columns: tuple[str, ...] = ()
    audit: tuple[tuple[str, str, str, str, str], ...] = ()
    tie_break: tuple[str, ...] = (ROW_NUMBER,)
    derive_time_parts: bool = True

    @property
    def numeric_features(self) -> tuple[str, ...]:
        """Numeric model inputs, the two derived time parts last."""
        return self.numeric + ((HOUR, WEEKDAY) if self.derive_time_parts else ())

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric_features + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        """Stored names of the raw columns, in file order."""
        if self.source_columns:
            return tuple(snake_case(name) for name in self.source_columns)
        return (self.id, self.time, *self.categorical, *self.numeric, self.target)

    def without(self, names: Sequence[str]) -> TableSpec:
        """The same table with some features left out."""
        from dataclasses import replace

        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c not in names),
            categorical=tuple(c for c in self.categorical if c not in names),
            binary=tuple(c for c in self.binary if c not in names),
            ranges={c: r for c, r in self.ranges.items() if c not in names},
        )

    def conservative(self) -> TableSpec:
        return self.without(self.questionable)

    def check_audit(self) -> None:
        """No column that the availability audit excludes may be a feature."""
        banned = {snake_case(row[0]) for row in self.audit if row[3] != "Include"}
        leaked = sorted(banned & set(self.features))
        if leaked:
            raise DataContractError(f"columns excluded by the audit are used as features: {leaked}")


def snake_case(name: str) -> str:
    return name.lower().replace(" ", "_")
