"""Job parameters: year specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicpanel.functions.expressions import years_between


@dataclass(frozen=True)
class Years:
    """Either an inclusive range or an explicit list of years."""

    years: tuple[int, ...]
    is_range: bool

    @classmethod
    def parse(cls, text: str) -> Years:
        """``"2015-2023"`` is a range, ``"2015,2018"`` a list."""
        if "-" in text:
            first, last = (int(part) for part in text.split("-"))
            return cls((first, last), True)
        return cls(tuple(int(part) for part in text.split(",")), False)

    @property
    def first(self) -> int:
        return min(self.years)

    @property
    def last(self) -> int:
        return max(self.years)

    def span(self) -> Years:
        """The whole range from the first to the last year named."""
        return Years((self.first, self.last), True)

    def matches(self, year: str | Column) -> Column:
        year = F.col(year) if isinstance(year, str) else year
        if self.is_range:
            return year.between(self.first, self.last)
        return year.isin(list(self.years))

    def covers(self, moment: str | Column) -> Column:
        """The years of a date or timestamp, as a range that parquet can use and the exact years in it."""
        moment = F.col(moment) if isinstance(moment, str) else moment
        return years_between(moment, self.first, self.last) & self.matches(F.year(moment))
