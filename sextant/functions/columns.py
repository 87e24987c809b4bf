"""Pure column builders (no actions): parsing, row arithmetic, flags, bins.

Every builder returns a ``Column`` so it stays inside whole-stage codegen.
Missing-value rules follow the table semantics of the source pipeline:
a comparison with a missing value is false, and row sums skip missing values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(c) -> Column:
    """NaN becomes NULL (Spark orders NaN above everything and averages it)."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# -- parsing -----------------------------------------------------------------

def split_part(c, sep: str, index: int, limit: int = -1) -> Column:
    """Part ``index`` (0-based) of ``c`` split at literal ``sep``; NULL if absent."""
    pattern = "\\Q" + sep + "\\E"
    return F.get(F.split(_c(c), pattern, limit), index)


def split_composite_key(c, sep: str = "_") -> tuple[Column, Column]:
    """``gggg_pp`` -> (group number, member number); non-numbers become NULL."""
    first = split_part(c, sep, 0)
    second = split_part(c, sep, 1)
    return first.try_cast("bigint"), second.try_cast("bigint")


def parse_delimited_field(c, sep: str = "/", sentinel: str | None = "U/9999/U"):
    """Three-part field ``a/n/b``: missing -> sentinel, middle part numeric
    (bad number -> NULL). Returns (first, number, last)."""
    src = _c(c)
    if sentinel is not None:
        src = F.coalesce(src, F.lit(sentinel))
    return (split_part(src, sep, 0), split_part(src, sep, 1).try_cast("double"),
            split_part(src, sep, 2))


def surname_extract(c, missing: str = "Unknown") -> Column:
    """Everything after the first space; no space or missing -> ``missing``."""
    src = F.coalesce(_c(c), F.lit(f"{missing} {missing}"))
    return F.coalesce(F.get(F.split(src, " ", 2), 1), F.lit(missing))


# -- row arithmetic ------------------------------------------------------------

def row_sum(cols) -> Column:
    """Sum across columns, missing values as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in cols])


def positive_count(cols) -> Column:
    """Number of columns with a value > 0 (missing counts as not positive)."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(_c(c) > 0, F.lit(False)).cast("int") for c in cols])


def safe_divide(num, den) -> Column:
    """num / den with a zero divisor replaced by 1."""
    den = _c(den)
    return _c(num) / F.when(den == 0, F.lit(1)).otherwise(den)


def row_entropy(cols, total=None, floor: float = 1e-9) -> Column:
    """-sum p ln p with p = clip(c / total, 0, 1), zero shares replaced by
    ``floor`` (so an all-zero row is not 0)."""
    total = row_sum(cols) if total is None else _c(total)
    den = F.when(total == 0, F.lit(1.0)).otherwise(total)
    terms = []
    for c in cols:
        p = F.least(F.greatest(_c(c) / den, F.lit(0.0)), F.lit(1.0))
        p = F.when(p == 0, F.lit(floor)).otherwise(p)
        terms.append(F.when(_c(c).isNull(), F.lit(0.0)).otherwise(p * F.ln(p)))
    return -reduce(lambda a, b: a + b, terms)


def argmax_name(cols, names=None) -> Column:
    """Name of the column holding the row maximum; the first column wins ties."""
    names = list(names or cols)
    vals = F.array(*[_c(c).cast("double") for c in cols])
    return F.element_at(F.array(*[F.lit(n) for n in names]),
                        F.array_position(vals, F.array_max(vals)).cast("int"))


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int, where an unknown (NULL) result is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def parity(c, missing: int = -1) -> Column:
    return F.coalesce(F.pmod(_c(c), F.lit(2)).cast("int"), F.lit(missing))


def category_cross(*cols, sep: str = "_", missing: str = "nan") -> Column:
    """``a_b`` text cross where a missing part is the text ``missing``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(missing)) for c in cols])


def bool_text(c, default: str = "False") -> Column:
    c = _c(c)
    return F.when(c, F.lit("True")).when(~c, F.lit("False")).otherwise(F.lit(default))


def infer_flag_from_amounts(flag_col, amounts) -> Column:
    """Unknown flag filled from spending: any spend -> False, none -> True."""
    f, s = _c(flag_col), row_sum(amounts)
    return (F.when(f.isNull() & (s > 0), F.lit(False))
             .when(f.isNull() & (s == 0), F.lit(True))
             .otherwise(f))


def zero_under_flag(c, flag_col) -> Column:
    return F.when(F.coalesce(_c(flag_col), F.lit(False)), F.lit(0.0)).otherwise(_c(c))


# -- binning ---------------------------------------------------------------

# Fixed values (must equal the source pipeline): labelled age bands, right-closed.
AGE_BAND_EDGES = [-1, 12, 18, 25, 40, 60, 120]
AGE_BAND_LABELS = ["child", "teen", "young_adult", "adult", "midlife", "senior"]

# Exploratory age bins, right-closed edges.
EDA_AGE_EDGES = [0, 13, 18, 25, 40, 60, 120]


def right_closed_band(c, edges, labels, outside="nan") -> Column:
    """Label of the interval (e_i, e_{i+1}] holding ``c``; outside -> ``outside``."""
    c = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(outside))


def right_closed_index(c, edges, include_lowest: bool = False) -> Column:
    """0-based interval index of (e_i, e_{i+1}], NULL outside."""
    c = _c(c)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = ((c >= lo) if (include_lowest and i == 0) else (c > lo)) & (c <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def equal_width_code(c, lo: Column, hi: Column, n_bins: int = 10, missing: int = -1) -> Column:
    """Equal-width code over [lo, hi] with right-closed bins; the lowest edge is
    lowered by 0.1 % of the range so the minimum lands in bin 0."""
    c = _c(c)
    width = (hi - lo) / F.lit(float(n_bins))
    code = F.ceil((c - lo) / width).cast("int") - 1
    code = F.least(F.greatest(code, F.lit(0)), F.lit(n_bins - 1))
    code = F.when(hi == lo, F.lit(0)).otherwise(code)
    # greatest/least skip NULLs, so a missing value is handled first
    return F.when(c.isNull(), F.lit(missing)).otherwise(code)


def rank_in_edges(c, edges: Column) -> Column:
    """Right-closed bin ordinal of ``c`` against a sorted edge array (lowest
    edge included): number of edges strictly below ``c``, minus one, floored at 0."""
    c = _c(c)
    below = F.size(F.filter(edges, lambda e: e < c))
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(below - 1, F.lit(0)))


def slugify(c, fallback: str = "item") -> Column:
    """lowercase, runs of non ``[a-z0-9]`` -> ``_``, trimmed of ``_``."""
    s = F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.when((s == "") | s.isNull(), F.lit(fallback)).otherwise(s)
