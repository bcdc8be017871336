"""Small column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Length that the ranges [a, b) and [c, d) share."""
    return F.greatest(F.lit(0.0), F.least(b, d) - F.greatest(a, c))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once: else it is written out, and worked out again, at each place that names it, and in a lambda for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def let_all(values: dict[str, Column], use: Callable[..., Column]) -> Column:
    """let for several values by name."""
    return let(F.struct(*[v.alias(k) for k, v in values.items()]), lambda g: use(**{k: g[k] for k in values}))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def rounded(x: Column, places: int) -> Column:
    """x to so many places, halves away from zero as its binary value times 10^places says it (F.round goes by the shortest decimal, so 14.624999999999998 and its like differ)."""
    return F.round(x * 10.0**places) / 10.0**places


def errors(*rules: tuple[Column, str]) -> Column:
    """The codes of the rules that hold, in the order given; empty: valid. A rule of unknown truth does not hold."""
    codes = [F.when(F.coalesce(rule, F.lit(False)), F.lit(code)) for rule, code in rules]
    return F.array_compact(F.array(*codes))


def share(xs: Column, ys: Column) -> Column:
    """Do two arrays share an element? Missing or empty: no."""
    return F.coalesce(F.arrays_overlap(F.array_compact(xs), F.array_compact(ys)), F.lit(False))


def jaccard(xs: Column, ys: Column) -> Column:
    """Shared elements of two sets among all; 0 if both are empty."""
    all_ = F.size(F.array_union(xs, ys))
    return F.when(all_ > 0, F.size(F.array_intersect(xs, ys)) / all_).otherwise(0.0)


def tokens(text: Column, least: int = 3) -> Column:
    """Distinct lower-case words of at least so many characters, in the order of their first place."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)([\wáéíóúñ]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= least))


def union_area(boxes: Sequence[Column]) -> Column:
    x0, y0 = F.least(*[b["x"] for b in boxes]), F.least(*[b["y"] for b in boxes])
    x1, y1 = F.greatest(*[b["x"] + b["w"] for b in boxes]), F.greatest(*[b["y"] + b["h"] for b in boxes])
    return F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes struct(x, y, w, h); 0 where both are empty."""
    w = F.greatest(F.lit(0.0), F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]))
    h = F.greatest(F.lit(0.0), F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]))
    total = a["w"] * a["h"] + b["w"] * b["h"] - w * h
    return F.when(total > 0, w * h / total).otherwise(0.0)


def islands(joined: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Number, from 0, of the run a row is in: a run goes on where joined (to the row before) is true."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return F.sum(F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).over(by) - 1


def slug(text: Column, most: int = 48) -> Column:
    """Words of a name, accents folded, stop words left out, joined by hyphens."""
    stop = ["a", "an", "the", "of", "and", "el", "la", "los", "las", "de", "del", "y", "en", "un", "una"]  # fixed values
    flat = F.translate(F.lower(text), "áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc")
    words = F.filter(F.regexp_extract_all(flat, F.lit("([a-z0-9]+)"), F.lit(1)), lambda w: ~w.isin(stop))
    return F.regexp_replace(F.substring(F.array_join(words, "-"), 1, most), "-+$", "")
