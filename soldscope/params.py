"""Validated parameters of a product search and the scopes derived from them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import date

from soldscope.schema import SHOPS

PAGE_SIZE = 20
MAX_PAGE_SIZE = 100


def split_keywords(text: str | None) -> tuple[str, ...]:
    """Words between blanks, commas or full-width commas."""
    return tuple(w for w in re.split(r"[\s,，]+", text or "") if w)


def resolve_shops(codes: Iterable[str] | None) -> tuple[str, ...]:
    """Known codes in upper case; none left means all shops."""
    asked = [c.strip().upper() for c in codes or ()]
    known = tuple(c for c in SHOPS if c in asked)
    return known or SHOPS


def ordered_range(start: date, end: date) -> tuple[date, date]:
    return (end, start) if start > end else (start, end)


@dataclass(frozen=True)
class Search:
    keywords: tuple[str, ...] = ()
    colors: tuple[str, ...] = ()
    exclude_colors: tuple[str, ...] = ()
    conditions: tuple[str, ...] = ()
    exclude_conditions: tuple[str, ...] = ()
    materials: tuple[str, ...] = ()
    exclude_materials: tuple[str, ...] = ()
    years: tuple[str, ...] = ()
    exclude_years: tuple[str, ...] = ()
    shops: tuple[str, ...] = ()
    start: date | str | None = None
    end: date | str | None = None
    brand: str | None = None
    product: str | None = None

    def query_scope(self) -> "Search":
        """Search without the picked product."""
        return replace(self, brand=None, product=None)

    def condition_scope(self) -> "Search":
        """Search without the condition includes, so that the facet still shows the other values."""
        return replace(self, conditions=())

    def color_scope(self) -> "Search":
        return replace(self, colors=())

    def shared_scope(self) -> "Search":
        """Widest scope that contains every other one."""
        return replace(self, brand=None, product=None, conditions=(), colors=())


@dataclass(frozen=True)
class Page:
    number: int = 1
    size: int = PAGE_SIZE

    @property
    def offset(self) -> int:
        return (self.number - 1) * self.size


def _values(request: Mapping[str, list[str]], key: str) -> tuple[str, ...]:
    return tuple(v.strip() for v in request.get(key, ()) if v and v.strip())


def _first(request: Mapping[str, list[str]], key: str) -> str | None:
    values = request.get(key) or [None]
    return (values[0] or "").strip() or None


def parse_search(request: Mapping[str, list[str]]) -> Search:
    """Repeated request keys to a parameter set; blanks are dropped."""
    return Search(
        keywords=split_keywords(_first(request, "q")),
        colors=_values(request, "color"),
        exclude_colors=_values(request, "excludeColor"),
        conditions=_values(request, "condition"),
        exclude_conditions=_values(request, "excludeCondition"),
        materials=_values(request, "material"),
        exclude_materials=_values(request, "excludeMaterial"),
        years=_values(request, "year"),
        exclude_years=_values(request, "excludeYear"),
        shops=_values(request, "shop"),
        start=_first(request, "start"),
        end=_first(request, "end"),
        brand=_first(request, "brand"),
        product=_first(request, "product"),
    )


def _leading_int(text: str | None) -> int | None:
    found = re.match(r"\s*[+-]?\d+", text or "")
    return int(found.group()) if found else None


def parse_page(request: Mapping[str, list[str]]) -> Page:
    number = _leading_int(_first(request, "page"))
    size = _leading_int(_first(request, "pageSize"))
    return Page(
        number if number and number > 0 else 1,
        min(size, MAX_PAGE_SIZE) if size and size > 0 else PAGE_SIZE,
    )
