"""Request objects: what to score, with which columns, filters and level."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from evenground.catalogs import DEFAULT_YEAR, LEVELS, YEARS

# an uploaded column called GEOID is kept under this name, which an uploaded
# table must not use itself
RESERVED_ID = "GEOID_input"

BAD_SPEC = "form_data_parameter_validation_failed"
BAD_FILTER = "filter_value_not_valid"


def filter_date(text: str) -> datetime:
    """Date of a filter, written mm/dd/yyyy."""
    return datetime.strptime(text.strip(), "%m/%d/%Y")


def input_name(column: str | None) -> str | None:
    return RESERVED_ID if column == "GEOID" else column


@dataclass(frozen=True)
class Filter:
    """One row filter.

    ``kind`` is number, string or date; ``op`` is a comparison, ``singleDate``
    or ``dateRange``; dates are written mm/dd/yyyy, ranges ``from-to``.
    """

    column: str
    kind: str
    op: str
    value: str | int | float

    @property
    def sound(self) -> bool:
        """The value can be read as its kind; a bad one is reported for its
        dataset before any job runs."""
        try:
            if self.op in ("singleDate", "dateRange"):
                dates = str(self.value).split("-") if self.op == "dateRange" else [str(self.value)]
                return len([filter_date(d) for d in dates]) == 1 + (self.op == "dateRange")
            return self.kind != "number" or math.isfinite(float(self.value))
        except (TypeError, ValueError):
            return False

    @classmethod
    def from_form(cls, form: Mapping) -> Filter:
        return cls(
            form["filter_column"], form["filter_type"], form["filter_comparison"], form["filter_val"]
        )


@dataclass(frozen=True)
class CustomColumns:
    """User columns: id column and estimate -> margin column (or None)."""

    id_column: str
    columns: Mapping[str, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class DisparitySpec:
    dataset_id: str
    lat_column: str | None
    lon_column: str | None
    geo: str | None
    filters: tuple[Filter, ...] = ()
    weight_column: str | None = None
    year: str = DEFAULT_YEAR
    demographic: CustomColumns | None = None
    geographic: CustomColumns | None = None
    sub_areas: bool = True
    # when set, this column splits one table into many datasets
    dataset_column: str | None = None

    @classmethod
    def from_form(cls, dataset_id: str, form: Mapping, year: str = DEFAULT_YEAR) -> DisparitySpec:
        """Build a spec from a submitted form; missing keys become None and
        are reported by :meth:`problems`."""

        def custom(kind: str) -> CustomColumns | None:
            if form.get(f"{kind}_geo_id_column"):
                return CustomColumns(form[f"{kind}_geo_id_column"], dict(form.get(f"{kind}_columns") or {}))
            return None

        return cls(
            dataset_id=dataset_id,
            lat_column=form.get("resource_lat_column"),
            lon_column=form.get("resource_lon_column"),
            geo=form.get("geo"),
            filters=tuple(Filter.from_form(f) for f in form.get("resource_filters") or ()),
            weight_column=form.get("resource_weight") or None,
            year=str(year),
            demographic=custom("demographic"),
            geographic=custom("geographic"),
        )

    @property
    def used_year(self) -> str:
        return self.year if self.year in YEARS else DEFAULT_YEAR

    @property
    def warnings(self) -> list[str]:
        return [] if self.year in YEARS else [f"year {self.year} not available, {DEFAULT_YEAR} used"]

    def problems(self) -> list[str]:
        missing = not (self.lat_column and self.lon_column and self.geo)
        if missing or self.geo not in LEVELS:
            return [BAD_SPEC]
        return [f"{BAD_FILTER}:{f.column}" for f in self.filters if not f.sound]

    def required_columns(self) -> dict[str, list[str]]:
        """Error name -> columns that must be present."""
        return {
            "latlon_cols_not_in_data": [input_name(self.lat_column), input_name(self.lon_column)],
            "filter_column_not_in_data": [input_name(f.column) for f in self.filters],
            "weight_column_not_in_data": [input_name(self.weight_column)] if self.weight_column else [],
        }
