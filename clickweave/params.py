"""Parameters of a batch task."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any


def _items(value: Any) -> tuple[str, ...]:
    """A comma list (or any iterable) as a tuple of texts; empty means no filter."""
    if value is None or value == "":
        return ()
    parts: Iterable[Any] = value.split(",") if isinstance(value, str) else value
    return tuple(str(part) for part in parts if str(part) != "")


def _text(value: Any) -> str | None:
    return None if value is None or value == "" else str(value)


def _number(value: Any) -> int | None:
    return None if value is None or value == "" else int(value)


@dataclass(frozen=True)
class TaskParams:
    """What a batch job is asked for. An absent or empty value switches its filter off."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> TaskParams:
        """Read the camel-case keys a task description uses."""
        return cls(
            start_date=_text(raw.get("startDate")),
            end_date=_text(raw.get("endDate")),
            start_age=_number(raw.get("startAge")),
            end_age=_number(raw.get("endAge")),
            professionals=_items(raw.get("professionals")),
            cities=_items(raw.get("cities")),
            sex=_text(raw.get("sex")),
            keywords=_items(raw.get("keywords")),
            category_ids=tuple(int(i) for i in _items(raw.get("categoryIds"))),
            target_page_flow=tuple(int(i) for i in _items(raw.get("targetPageFlow"))),
        )

    @classmethod
    def from_json(cls, text: str) -> TaskParams:
        return cls.from_mapping(json.loads(text))
