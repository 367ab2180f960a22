"""Moments and deviation from the mean over square windows, in time that doesn't depend on the window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aoi import odd_cells_of
from ..functions.cells import quoted

WHOLE = ("byte", "short", "integer", "long")


def half_width(k: int) -> int:
    """Of a window of k cells, made odd upwards and 3 at least."""
    return (max(3, k) | 1) // 2


def centred(cells: DataFrame, value: str, center: float | None) -> str:
    """The value as SQL: whole numbers as they are, others as doubles less the centre."""
    if cells.schema[value].dataType.typeName() in WHOLE:
        return f"cast({quoted(value)} as bigint)"
    return f"(cast({quoted(value)} as double) - {center or 0.0!r}D)"


def moments(cells: DataFrame, halves: dict[str, int], value: str = "z", center: float | None = None, wide: bool = False) -> DataFrame:
    """cells and n_<label>, s_<label>, q_<label>: count, sum and sum of squares of the values in the (2h+1)-wide square around each cell.

    cells must be dense. Windows end at the grid's edge and leave nulls out. Running sums along rows, then along columns, are taken at
    both ends of the window: two shuffles and two sorts for all labels, whatever their widths. Whole-number values are summed exactly;
    wide: squares as decimals, for values up to 1e14. The plan is a few selections of SQL text, which the driver makes quickly."""
    exact = cells.schema[value].dataType.typeName() in WHOLE
    z, zero = centred(cells, value, center), "0" if exact else "0D"
    square = f"cast(cast({z} as decimal(14,0)) * cast({z} as decimal(14,0)) as decimal(28,0))" if wide and exact else f"{z} * {z}"
    own = [quoted(c) for c in cells.columns]
    parts = {"n": f"cast({z} is not null as bigint)", "s": f"coalesce({z}, {zero})", "q": f"coalesce({square}, {zero})"}
    now = cells.selectExpr(*own, *(f"{x} as _moment_{m}" for m, x in parts.items()))
    sources = {m: {label: f"_moment_{m}" for label in halves} for m in parts}
    for axis, along, made in (("r", "c", "_row_{}_{}"), ("c", "r", "{}_{}")):
        line = f"partition by {axis} order by {along}"
        columns = sorted({x for by in sources.values() for x in by.values()})
        up_to = [f"sum({quoted(x)}) over ({line} rows between unbounded preceding and current row) as {quoted(x + '_p')}" for x in columns]
        total = [f"sum({quoted(x)}) over (partition by {axis}) as {quoted(x + '_t')}" for x in columns]
        now = now.selectExpr(*own, *up_to, *total)
        boxes = {(m, label): (x, halves[label]) for m, by in sources.items() for label, x in by.items()}
        ends = [
            f"coalesce(lead({quoted(x + '_p')}, {h}) over ({line}), {quoted(x + '_t')}) - coalesce(lag({quoted(x + '_p')}, {h + 1}) over ({line}), {zero}) as {quoted(made.format(m, label))}"
            for (m, label), (x, h) in boxes.items()
        ]
        now = now.selectExpr(*own, *ends)
        sources = {m: {label: made.format(m, label) for label in by} for m, by in sources.items()}
    return now


def deviation(n: str, s: str, q: str, z: str, wide: bool = False) -> str:
    """(z - mean) / population standard deviation as SQL; null without a value, 0 without spread. wide: products as decimals, for sums whose squares pass 2**63."""
    kind = (lambda x: f"cast({x} as decimal(38,0))") if wide else (lambda x: x)
    spread = f"({kind(n)} * {kind(q)} - {kind(s)} * {kind(s)})"
    return f"case when {z} is null then cast(null as double) when {spread} <= 0 then 0D else cast({n} * {z} - {s} as double) / sqrt(cast({spread} as double)) end"


def dev(cells: DataFrame, halves: dict[str, int], value: str = "z", center: float | None = None, most: int | None = None) -> DataFrame:
    """cells and dev_<label> for each half width.

    most: a bound of |value| for whole numbers. Where sums of squares of 2**30 cells or n² · most² may pass 2**63, or no bound is known, they are decimals. Other numbers are doubles, less
    `center` (default: their mean, asked beforehand), which keeps differences of large sums accurate."""
    exact = cells.schema[value].dataType.typeName() in WHOLE
    if not exact and center is None:
        center = cells.agg(F.avg(value)).first()[0] or 0.0
    center = None if exact else float(center)
    large = exact and (most is None or most * most >= 1 << 33)
    found = moments(cells, halves, value, center, large)
    wide = {x: large or exact and ((2 * h + 1) ** 2 * most) ** 2 >= 1 << 63 for x, h in halves.items()}
    z = centred(cells, value, center)
    devs = {x: deviation(*(quoted(f"{m}_{x}") for m in "nsq"), z, wide[x]) for x in halves}
    return found.selectExpr(*(quoted(c) for c in cells.columns if c not in {f"dev_{x}" for x in halves}), *(f"{e} as {quoted(f'dev_{x}')}" for x, e in devs.items()))


def multiscale_dev(cells: DataFrame, scales_m: dict[str, float], res: float, **how) -> DataFrame:
    """dev_<label> for window widths in metres."""
    return dev(cells, {x: half_width(odd_cells_of(m, res)) for x, m in scales_m.items()}, **how)


def multiscale_dev_cells(cells: DataFrame, widths: dict[str, int], **how) -> DataFrame:
    """dev_<label> and dev_abs_<label> for window widths in cells; even widths are made odd upwards."""
    found = dev(cells, {x: half_width(k) for x, k in widths.items()}, **how)
    return found.withColumns({f"dev_abs_{x}": F.abs(f"dev_{x}") for x in widths})
