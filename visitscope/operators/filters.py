"""Session filters driven by an analysis task.

Rule of every predicate: a parameter that is absent passes every session;
a data value that is absent fails. Profile predicates (age, profession,
city, sex) touch only `user_info` columns, so after the inner join
Catalyst moves them into the profile scan. Keyword and category
predicates keep or drop whole sessions, so they are evaluated on the
session roll-up: as per-row hits folded with `bool_or` (no lists needed),
or as list overlaps when the lists are already built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _split_values(values: Iterable[str] | str | None) -> tuple[str, ...]:
    """Parameter values: a comma list or a sequence of comma lists, blanks dropped."""
    if values is None:
        return ()
    if isinstance(values, str):
        values = [values]
    out: list[str] = []
    for v in values:
        if v is None:
            continue
        out.extend(part for part in str(v).split(",") if part != "")
    return tuple(dict.fromkeys(out))


def _age(value) -> int | None:
    if value is None or (isinstance(value, str) and value.strip() == ""):
        return None
    try:
        return int(str(value).strip())
    except ValueError as exc:
        raise ValueError(f"age parameter is not a whole number: {value!r}") from exc


@dataclass(frozen=True)
class FilterSpec:
    """The session filters of one analysis task; empty fields filter nothing."""

    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[str, ...] = ()

    @classmethod
    def of(cls, *, start_age=None, end_age=None, professionals=None, cities=None,
           sex=None, keywords=None, category_ids=None) -> "FilterSpec":
        """Build from loose values: comma lists or sequences, text or int ages."""
        sex_value = None if sex is None or str(sex) == "" else str(sex)
        return cls(
            start_age=_age(start_age),
            end_age=_age(end_age),
            professionals=_split_values(professionals),
            cities=_split_values(cities),
            sex=sex_value,
            keywords=_split_values(keywords),
            category_ids=_split_values(category_ids),
        )

    @property
    def has_age_range(self) -> bool:
        # A one-sided range is ignored, not half applied.
        return self.start_age is not None and self.end_age is not None


# ---- profile predicates (columns of user_info) ----

def age_predicate(spec: FilterSpec) -> Column | None:
    """Inclusive age range; needs both bounds (F1)."""
    if not spec.has_age_range:
        return None
    return F.col("age").between(spec.start_age, spec.end_age)


def professional_predicate(spec: FilterSpec) -> Column | None:
    """Profession is one of the listed ones (F2)."""
    return F.col("professional").isin(*spec.professionals) if spec.professionals else None


def city_predicate(spec: FilterSpec) -> Column | None:
    """City is one of the listed ones."""
    return F.col("city").isin(*spec.cities) if spec.cities else None


def sex_predicate(spec: FilterSpec) -> Column | None:
    """Sex equals the given value."""
    return (F.col("sex") == F.lit(spec.sex)) if spec.sex is not None else None


def profile_predicate(spec: FilterSpec) -> Column:
    """Conjunction of the profile predicates; `true` when none is set."""
    return _all([age_predicate(spec), professional_predicate(spec),
                 city_predicate(spec), sex_predicate(spec)])


# ---- session predicates: per action row, folded per session ----

def keyword_hit(spec: FilterSpec) -> Column | None:
    """This action searched one of the task's keywords (for `bool_or`, F5)."""
    if not spec.keywords:
        return None
    return F.col("search_keyword").isin(*spec.keywords)


def category_hit(spec: FilterSpec) -> Column | None:
    """This action clicked one of the task's categories (for `bool_or`, F6)."""
    if not spec.category_ids:
        return None
    numbers = _numbers(spec.category_ids)
    if not numbers or max(map(abs, numbers)) >= 2**31:
        return F.col("click_category_id").isin(*numbers)
    # One call into the JVM for the whole list.
    return F.expr(f"click_category_id IN ({', '.join(map(str, numbers))})")


def _numbers(ids: tuple[str, ...]) -> list[int]:
    """Category ids as numbers, once for the whole table; a text that is no bigint's decimal text matches no id."""
    return [int(i) for i in ids if re.fullmatch("0|-?[1-9][0-9]{0,18}", i) and -2**63 <= int(i) < 2**63]


def session_hit_aggregates(spec: FilterSpec) -> list[Column]:
    """`bool_or` aggregates that mark sessions passing F5 / F6."""
    aggs = []
    kw = keyword_hit(spec)
    if kw is not None:
        aggs.append(F.coalesce(F.bool_or(kw), F.lit(False)).alias("keyword_hit"))
    cat = category_hit(spec)
    if cat is not None:
        aggs.append(F.coalesce(F.bool_or(cat), F.lit(False)).alias("category_hit"))
    return aggs


def session_hit_predicate(spec: FilterSpec) -> Column:
    """Predicate over the columns made by `session_hit_aggregates`."""
    preds = []
    if spec.keywords:
        preds.append(F.col("keyword_hit"))
    if spec.category_ids:
        preds.append(F.col("category_hit"))
    return _all(preds)


# ---- session predicates over built lists ----

def keyword_list_predicate(spec: FilterSpec, column: str = "search_keywords") -> Column | None:
    """Session's keyword list shares a value with the task's list."""
    if not spec.keywords:
        return None
    return F.coalesce(F.arrays_overlap(F.col(column), F.array(*[F.lit(k) for k in spec.keywords])),
                      F.lit(False))


def category_list_predicate(spec: FilterSpec, column: str = "click_category_ids") -> Column | None:
    """Session's category list shares a value with the task's list."""
    if not spec.category_ids:
        return None
    wanted = F.array(*[F.lit(c) for c in _numbers(spec.category_ids)]).cast("array<bigint>")
    return F.coalesce(F.arrays_overlap(F.col(column), wanted), F.lit(False))


def session_list_predicate(spec: FilterSpec) -> Column:
    return _all([keyword_list_predicate(spec), category_list_predicate(spec)])


def _all(preds: list[Column | None]) -> Column:
    present = [p for p in preds if p is not None]
    if not present:
        return F.lit(True)
    return reduce(lambda a, b: a & b, present)
