"""What each raw source must look like before its rows are worth checking."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# The required columns of the four sources, in contract order,
# with the type a clean file holds.
CONTRACTS: dict[str, dict[str, str]] = {
    "yield": {
        "Domain Code": "string", "Domain": "string", "Area Code": "int", "Area": "string",
        "Element Code": "int", "Element": "string", "Item Code": "int", "Item": "string",
        "Year Code": "int", "Year": "int", "Unit": "string", "Value": "double",
    },
    "pesticides": {
        "Domain": "string", "Area": "string", "Element": "string", "Item": "string",
        "Year": "int", "Unit": "string", "Value": "double",
    },
    "rainfall": {"Area": "string", "Year": "int", "average_rain_fall_mm_per_year": "string"},
    "temp": {"year": "int", "country": "string", "avg_temp": "double"},
}


@dataclass(frozen=True)
class ContractResult:
    source: str
    missing: tuple[str, ...]

    @property
    def passed(self) -> bool:
        return not self.missing


def check_contract(columns: Iterable[str], source: str) -> ContractResult:
    """Names only: extra columns are fine, types are not looked at."""
    found = {name.strip() for name in columns}
    return ContractResult(source, tuple(name for name in CONTRACTS[source] if name not in found))
