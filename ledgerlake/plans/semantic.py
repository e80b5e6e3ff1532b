"""Semantic layer: views (dimensions + measures) and explores (join graphs).

``Explore.query`` turns a field list into ONE lazy DataFrame:

    explore grant -> field grants (silent drop) -> row policies on each
    view's base rows -> only the joins the fields need -> filters (with the
    always-filter unless the caller filters that field) -> groupBy / pivot
    -> aggregate -> sort (hidden companion fields allowed) -> drop hidden

Nothing is collected; Catalyst prunes every column the fields do not use
and pushes filters and policies into the scans.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact_ratio, money_sum
from ..functions.calendar import TIME_FRAMES, time_frame
from ..operators.governance import SERVICE_GROUP, Principal, RowPolicy, has_grant, require_grants, row_filter

Expr = Callable[[], Column] | str


def _col(expr: Expr) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr()


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: Expr
    label: str = ""
    hidden: bool = False
    order_by: str | None = None  # hidden companion field used for sorting
    grants: tuple[str, ...] = ()


@dataclass(frozen=True)
class Measure:
    """Aggregates: sum, average (4 dp, exact), count, count_distinct, min,
    max, or ratio (sum(expr) * times / sum(denominator), weighted)."""

    name: str
    agg: str
    expr: Expr = lambda: F.lit(1)
    label: str = ""
    grants: tuple[str, ...] = ()
    value_format: str | None = None
    drill_fields: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    denominator: Expr | None = None
    times: int = 1
    scale: int = 4


@dataclass(frozen=True)
class View:
    name: str
    base: Callable[[Any], DataFrame]
    dimensions: tuple[Dimension, ...] = ()
    measures: tuple[Measure, ...] = ()
    time_groups: Mapping[str, str] = field(default_factory=dict)  # group -> date column
    policy_table: str | None = None  # table name the row policies are declared on
    label: str = ""

    def extend(self, name: str | None = None, *, dimensions: Sequence[Dimension] = (),
               measures: Sequence[Measure] = (), **changes) -> View:
        """Refinement: a copy with added/replaced fields and other changes."""
        dims = {d.name: d for d in self.dimensions} | {d.name: d for d in dimensions}
        meas = {m.name: m for m in self.measures} | {m.name: m for m in measures}
        return dataclasses.replace(self, name=name or self.name, dimensions=tuple(dims.values()),
                                   measures=tuple(meas.values()), **changes)

    def field(self, name: str) -> Dimension | Measure | None:
        for d in self.dimensions:
            if d.name == name:
                return d
        for m in self.measures:
            if m.name == name:
                return m
        for group, col in self.time_groups.items():
            for frame in TIME_FRAMES:
                if name == f"{group}_{frame}":
                    return Dimension(name, (lambda c=col, fr=frame: time_frame(c, fr)))
        return None


@dataclass(frozen=True)
class Join:
    view: View
    left: str   # "view.column" on an already joined view
    right: str  # column of ``view``
    fields: tuple[str, ...] | None = None  # visible subset of the joined view
    how: str = "left"


@dataclass(frozen=True)
class Explore:
    name: str
    base: View
    joins: tuple[Join, ...] = ()
    always_filter: Mapping[str, Any] = field(default_factory=dict)
    required_grants: tuple[str, ...] = ()
    label: str = ""

    # -- resolution ---------------------------------------------------------
    def _views(self) -> dict[str, View]:
        return {self.base.name: self.base, **{j.view.name: j.view for j in self.joins}}

    def resolve(self, ref: str) -> tuple[str, Dimension | Measure]:
        views = self._views()
        if "." in ref:
            vname, fname = ref.split(".", 1)
            if vname not in views:
                raise KeyError(f"view {vname!r} is not in explore {self.name!r}")
            j = next((j for j in self.joins if j.view.name == vname), None)
            if j is not None and j.fields is not None and fname not in j.fields:
                raise KeyError(f"field {ref!r} is not exposed by the join")
            f = views[vname].field(fname)
            if f is None:
                raise KeyError(ref)
            return vname, f
        for vname, v in views.items():
            f = v.field(ref)
            if f is not None:
                return vname, f
        raise KeyError(ref)

    def _join_path(self, needed: set[str]) -> list[Join]:
        """Joins required for ``needed`` views, parents first (join on demand)."""
        by_view = {j.view.name: j for j in self.joins}
        out: list[Join] = []

        def need(v: str) -> None:
            if v == self.base.name or v in [j.view.name for j in out]:
                return
            j = by_view[v]
            need(j.left.split(".", 1)[0])
            out.append(j)

        for v in sorted(needed):
            need(v)
        return out

    # -- query ---------------------------------------------------------------
    def query(self, ctx: Any, fields: Sequence[str], *, principal: Principal,
              filters: Mapping[str, Any] | None = None, pivot: str | None = None,
              pivot_values: Sequence[Any] | None = None, sorts: Sequence[tuple[str, str]] = (),
              policies: Sequence[RowPolicy] | None = None, as_of: dt.date | str | None = None,
              check_fanout: bool = False, pivot_other: str | None = None) -> DataFrame:
        """Build the query. ``check_fanout=True`` first verifies (one small
        aggregate per joined view) that every many-to-one join key is unique
        on the "one" side, raising ``FanOutError`` instead of double counting."""
        from ..operators.governance import default_policies

        require_grants(principal, self.required_grants, f"explore {self.name}")
        policies = default_policies() if policies is None else policies
        filters = dict(filters or {})
        for k, v in self.always_filter.items():
            if not any(self._same_field(k, f) for f in filters):
                filters[k] = v

        wanted = [(ref, *self.resolve(ref)) for ref in fields]
        wanted = [w for w in wanted if has_grant(principal, w[2].grants)]  # silent drop
        dims = [w for w in wanted if isinstance(w[2], Dimension)]
        meas = [w for w in wanted if isinstance(w[2], Measure)]
        pivot_ref = self.resolve(pivot) if pivot else None
        sort_refs = [(self.resolve(s), d) for s, d in sorts]
        hidden = []
        for (vname, f), _ in sort_refs:
            if isinstance(f, Dimension) and f.order_by:
                hidden.append((vname, self._views()[vname].field(f.order_by)))
        filter_refs = [(self.resolve(k), v) for k, v in filters.items()]
        # A field that may not be read may not be learnt by filtering, sorting or pivoting either.
        used = [f for (_, f), _ in filter_refs] + [f for (_, f), _ in sort_refs] + ([pivot_ref[1]] if pivot_ref else [])
        for f in used:
            require_grants(principal, f.grants, f"field {f.name}")

        needed = {w[1] for w in wanted} | {v for (v, _), _ in filter_refs} | {v for v, _ in hidden}
        needed |= {pivot_ref[0]} if pivot_ref else set()
        joins = self._join_path(needed - {self.base.name})

        def prefixed(vname: str, f: Dimension | Measure) -> str:
            return f"{vname}__{f.name}"

        # Columns each view must provide, computed on its own base rows.
        per_view: dict[str, dict[str, Column]] = {}

        def add(vname: str, f: Dimension | Measure) -> None:
            cols = per_view.setdefault(vname, {})
            cols[prefixed(vname, f)] = _col(f.expr)
            if isinstance(f, Measure) and f.denominator is not None:
                cols[prefixed(vname, f) + "__den"] = _col(f.denominator)

        for _, v, f in wanted:
            add(v, f)
        for (v, f), _ in filter_refs:
            add(v, f)
        for v, f in hidden:
            add(v, f)
        if pivot_ref:
            add(*pivot_ref)
        for j in joins:
            lv, lc = j.left.split(".", 1)
            per_view.setdefault(lv, {})[f"{lv}__{lc}"] = F.col(lc)
            per_view.setdefault(j.view.name, {})[f"{j.view.name}__{j.right}"] = F.col(j.right)

        views = self._views()
        # Row policies see the principal's groups plus the service identity
        # the semantic layer queries with.
        querying = Principal(principal.department, principal.groups | {SERVICE_GROUP})

        def frame(vname: str) -> DataFrame:
            v = views[vname]
            base = v.base(ctx)
            if v.policy_table:
                base = base.where(row_filter(v.policy_table, querying, policies))
            return base.select(*[c.alias(n) for n, c in per_view.get(vname, {"__one": F.lit(1)}).items()])

        measures_from_base = all(v == self.base.name for _, v, _ in meas)
        eager = bool(joins) and bool(meas) and measures_from_base and all(f.agg in DECOMPOSABLE for _, _, f in meas)

        df = frame(self.base.name)
        if eager:
            # Eager aggregation: filters on the base view first, then collapse
            # base rows to (dimensions, filter columns, join keys) before the
            # many-to-one joins, so the joins see one row per group, not per
            # fact row. Measures are re-aggregated after the joins.
            for (v, f), value in filter_refs:
                if v == self.base.name:
                    df = df.where(_filter(F.col(prefixed(v, f)), value, as_of))
            measure_cols = {prefixed(v, f) for _, v, f in meas}
            measure_cols |= {c + "__den" for c in measure_cols}
            keys = [c for c in df.columns if c not in measure_cols]
            partial = []
            for _, v, f in meas:
                partial += _partial(f, prefixed(v, f), df.schema)
            df = df.groupBy(*keys).agg(*partial)
        for j in joins:
            lv, lc = j.left.split(".", 1)
            right = frame(j.view.name)
            if check_fanout:
                _assert_unique(right, f"{j.view.name}__{j.right}", j.view.name)
            df = df.join(right, F.col(f"{lv}__{lc}") == F.col(f"{j.view.name}__{j.right}"), j.how)

        for (v, f), value in filter_refs:
            if not (eager and v == self.base.name):
                df = df.where(_filter(F.col(prefixed(v, f)), value, as_of))

        out_names = _output_names([(v, f) for _, v, f in wanted])
        group_cols = [F.col(prefixed(v, f)).alias(out_names[(v, f.name)]) for _, v, f in dims]
        group_cols += [F.col(prefixed(v, f)).alias(f"__hidden__{f.name}") for v, f in hidden]
        final = _final if eager else _aggregate
        aggs = [final(f, prefixed(v, f)).alias(out_names[(v, f.name)]) for _, v, f in meas]
        if pivot_ref:
            if pivot_values is None:
                raise ValueError("pivot needs an explicit list of values")
            values, name = list(pivot_values), prefixed(*pivot_ref)
            if pivot_other is not None:  # values outside the list, and NULL, share one column
                df = df.withColumn(name, F.when(F.col(name).isin(values), F.col(name)).otherwise(F.lit(pivot_other)))
                values.append(pivot_other)
            grouped = df.groupBy(*group_cols).pivot(name, values)
            result = grouped.agg(*aggs) if len(aggs) > 1 else grouped.agg(aggs[0])
        elif group_cols:
            result = df.groupBy(*group_cols).agg(*aggs) if aggs else df.select(*group_cols).distinct()
        else:
            result = df.agg(*aggs)

        if sort_refs:
            order = []
            for (v, f), direction in sort_refs:
                name = (f"__hidden__{f.order_by}" if isinstance(f, Dimension) and f.order_by
                        else out_names.get((v, f.name), f.name))
                c = F.col(name)
                order.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first())
            result = result.orderBy(*order)
        drop = [c for c in result.columns if c.startswith("__hidden__")]
        return result.drop(*drop) if drop else result

    def _same_field(self, a: str, b: str) -> bool:
        try:
            return self.resolve(a)[1].name == self.resolve(b)[1].name and self.resolve(a)[0] == self.resolve(b)[0]
        except KeyError:
            return False


class FanOutError(ValueError):
    """A many-to-one join's "one" side repeats a key."""


def _assert_unique(df: DataFrame, key: str, view: str) -> None:
    dupes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col(key).isNotNull() & (F.col("_n") > 1)).count()
    if dupes:
        raise FanOutError(f"join key {key!r} of view {view!r} repeats for {dupes} value(s)")


def _output_names(fields: Sequence[tuple[str, Dimension | Measure]]) -> dict[tuple[str, str], str]:
    counts: dict[str, int] = {}
    for _, f in fields:
        counts[f.name] = counts.get(f.name, 0) + 1
    return {(v, f.name): (f.name if counts[f.name] == 1 else f"{v}_{f.name}") for v, f in fields}


AVERAGE_SUM_TYPE = "decimal(24,4)"
DECOMPOSABLE = {"sum", "average", "count", "min", "max", "ratio"}


def _sum(col: str, schema: T.StructType | None = None) -> Column:
    """SUM; exact BIGINT accumulation for narrow decimals (see money_sum)."""
    if schema is not None and col in schema.fieldNames():
        t = schema[col].dataType
        if isinstance(t, T.DecimalType) and t.precision <= 18 and t.scale <= 6:
            return money_sum(col, t.scale)
    return F.sum(col)


def _partial(m: Measure, col: str, schema: T.StructType) -> list[Column]:
    """Per-group partial state of a decomposable measure (eager aggregation)."""
    c = F.col(col)
    if m.agg == "sum":
        return [_sum(col, schema).alias(col)]
    if m.agg == "count":
        return [F.count(F.lit(1)).alias(col)]
    if m.agg == "average":
        return [_sum(col, schema).alias(col + "__s"), F.count(c).alias(col + "__c")]
    if m.agg == "ratio":
        return [_sum(col, schema).alias(col), _sum(col + "__den", schema).alias(col + "__den")]
    if m.agg in ("min", "max"):
        return [getattr(F, m.agg)(c).alias(col)]
    raise ValueError(f"{m.agg!r} is not decomposable")


def _final(m: Measure, col: str) -> Column:
    """Combine partial states after the joins."""
    c = F.col(col)
    if m.agg == "count":
        return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))  # no rows: 0, as a plain count gives
    if m.agg == "sum":
        return F.sum(c)
    if m.agg == "average":
        return exact_ratio(F.sum(col + "__s"), F.sum(col + "__c"), m.scale, num_type=AVERAGE_SUM_TYPE)
    if m.agg == "ratio":
        return exact_ratio(F.sum(c), F.sum(col + "__den"), m.scale, times=m.times,
                           num_type=AVERAGE_SUM_TYPE, den_type=AVERAGE_SUM_TYPE)
    return getattr(F, m.agg)(c)


def _aggregate(m: Measure, col: str) -> Column:
    c = F.col(col)
    if m.agg == "sum":
        return F.sum(c)
    if m.agg == "average":
        # Unweighted mean of the row values, exact and HALF_UP at ``scale``.
        return exact_ratio(F.sum(c), F.count(c), m.scale, num_type=AVERAGE_SUM_TYPE)
    if m.agg == "count":
        return F.count(F.lit(1))
    if m.agg == "count_distinct":
        return F.count_distinct(c)
    if m.agg == "min":
        return F.min(c)
    if m.agg == "max":
        return F.max(c)
    if m.agg == "ratio":
        return exact_ratio(F.sum(c), F.sum(F.col(col + "__den")), m.scale, times=m.times,
                           num_type=AVERAGE_SUM_TYPE, den_type=AVERAGE_SUM_TYPE)
    raise ValueError(f"unknown aggregate {m.agg!r}")


_RELATIVE = re.compile(r"^\s*(\d+)\s+days?\s*$")


def _filter(c: Column, value: Any, as_of: dt.date | str | None) -> Column:
    """Filter forms: 'N days' (relative to as_of), (start, end) half-open
    range (either side may be None), list/set (IN; empty = all), callable,
    or a scalar (equality)."""
    if isinstance(value, str) and _RELATIVE.match(value):
        if as_of is None:
            raise ValueError("a relative date filter needs as_of")
        n = int(_RELATIVE.match(value).group(1))
        today = F.lit(as_of).cast("date")
        return (c > F.date_sub(today, n)) & (c <= today)
    if isinstance(value, tuple) and len(value) == 2:
        lo, hi = value
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= F.lit(lo).cast("date") if isinstance(lo, (str, dt.date)) else c >= lo)
        if hi is not None:
            cond = cond & (c < F.lit(hi).cast("date") if isinstance(hi, (str, dt.date)) else c < hi)
        return cond
    if isinstance(value, (list, set, frozenset)):
        return F.lit(True) if not value else c.isin(list(value))
    if callable(value):
        return value(c)
    return c == F.lit(value)
