"""Small column functions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on the parts' values alone, not on partitioning: 32 bits of an md5."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digest = F.md5(F.concat_ws("|", *(c.cast("string") for c in columns)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def dot(a: str, b: str) -> Column:
    """Sum of products of two arrays of equal length, in doubles."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x AS double) * cast(y AS double)), 0D, (s, x) -> s + x)")


def l2_norm(v: str) -> Column:
    """Euclidean length of an array."""
    return F.sqrt(F.expr(f"aggregate({v}, 0D, (s, x) -> s + cast(x AS double) * cast(x AS double))"))


def unit(v: str) -> Column:
    """The array scaled to length 1; NULL where its length is 0 or not finite."""
    norm = l2_norm(v)
    return F.when((norm > 0) & (norm < float("inf")), F.transform(v, lambda x: x.cast("double") / norm))


def average(a: str, b: str) -> Column:
    """Elementwise mean of two arrays."""
    return F.expr(f"zip_with({a}, {b}, (x, y) -> (x + y) / 2)")


def chunk_sizes(total: int, parts: int) -> list[int]:
    """``parts`` equal chunks of ``total``, and one chunk more for a remainder."""
    even = [total // parts] * parts
    return even if total % parts == 0 else [*even, total % parts]


def text_of(items: Column, delimiter: str) -> Column:
    """An array as delimited text."""
    return F.array_join(F.transform(items, lambda x: x.cast("string")), delimiter)


def stamp() -> Column:
    """The current local time as year_month_day_hour_minute without padding."""
    return F.date_format(F.current_timestamp(), "y_M_d_H_m")
