"""Declarative description of an extract."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Literal


@dataclass(frozen=True)
class Dimension:
    """``lookup`` says where the codes come from: the data, the year-end labels, or a given table."""

    code: str
    title: str
    lookup: Literal["generated", "year_end", "supplied"] = "generated"


@dataclass(frozen=True)
class Measure:
    code: str
    title: str
    decimals: int = 0


@dataclass(frozen=True)
class ExtractSpec:
    """One star-schema extract. The first year-end dimension holds the rolling years."""

    table_id: str
    title: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    table_code: str = ""
    on_unmatched: Literal["drop", "fail"] = "fail"
    # name of a count of fact rows that the base holds for control figures; it is not published
    row_count: str = ""
    # pairs of dimensions whose breakdowns of the first measure have to agree
    breakdowns: tuple[tuple[str, str], ...] = ()
    # pairs of dimensions of which the first determines the second; the cube then sums fewer combinations
    follows: tuple[tuple[str, str], ...] = ()

    @property
    def dims(self) -> list[str]:
        return [d.code for d in self.dimensions]

    @property
    def year_dim(self) -> str:
        return next(d.code for d in self.dimensions if d.lookup == "year_end")

    @property
    def detail_dims(self) -> list[str]:
        return [d for d in self.dims if d != self.year_dim]

    @property
    def measure_codes(self) -> list[str]:
        return [m.code for m in self.measures]

    @property
    def code(self) -> str:
        return self.table_code or f"TABLECODE{self.table_id}"

    def file_name(self, prefix: str, dim: str = "") -> str:
        """``Data7578``, ``DimenLookupTripType7579``: no quotes or underscores in the dimension."""
        return prefix + re.sub('["_]', "", dim) + self.table_id
