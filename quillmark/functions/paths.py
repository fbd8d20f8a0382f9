"""POSIX paths as columns: absolute, relative to a folder, inside JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from .text import strip

#: What isn't a path of a file.
FOREIGN = r"^(#|https?://|data:|mailto:|javascript:)"
#: Fields of records that hold paths.
PATH_KEYS = ("image_path", "artifact_path", "hires_image_path", "export_path")

_NONE = "cast(array() as array<string>)"


def segments(path: Column) -> Column:
    """The parts of an absolute path, without . and with .. taken back."""
    last = lambda acc: F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
    step = lambda acc, x: F.when(x.isin("", "."), acc).when(x == "..", last(acc)).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(F.split(path, "/"), F.expr(_NONE), step)


def unwrapped(href: Column) -> Column:
    """Without white space and one pair of angle brackets around it."""
    x = strip(href)
    return F.when(x.rlike(r"^<[\s\S]*>$") & (F.length(x) >= 2), strip(F.substr(x, F.lit(2), F.length(x) - 2))).otherwise(x)


def relative_path(href: Column, folder: Column) -> Column:
    """``href`` relative to the absolute ``folder``; null if it is no path of a
    file or needs no change."""
    x = unwrapped(href)
    target = segments(F.when(F.startswith(x, F.lit("/")), x).otherwise(F.concat(folder, F.lit("/"), x)))
    base = segments(folder)
    shared = F.aggregate(F.sequence(F.lit(0), F.least(F.size(target), F.size(base))), F.lit(0), lambda n, i: F.when((n == i) & (F.get(target, i) == F.get(base, i)), n + 1).otherwise(n))
    rest = F.slice(target, shared + 1, F.size(target))
    out = F.array_join(F.concat(F.array_repeat(F.lit(".."), F.size(base) - shared), rest), "/")
    out = F.when(out == "", ".").otherwise(out)
    return F.when((x != "") & ~x.rlike(FOREIGN) & (out != x), out)


def inside(path: Column, folder: Column) -> Column:
    """``path`` relative to ``folder`` if it lies in it, else as it is."""
    whole, base = segments(path), segments(folder)
    within = F.array_join(F.slice(whole, 1, F.greatest(F.size(base), F.lit(1))), "/") == F.array_join(base, "/")
    return F.when(within & (F.size(whole) > F.size(base)), F.array_join(F.slice(whole, F.size(base) + 1, F.size(whole)), "/")).otherwise(path)


def rewritten_keys(x: Column, kind: DataType, folder: Column, keys: tuple[str, ...] = PATH_KEYS) -> Column:
    """A record with the paths under ``keys`` relative to ``folder``, at any depth."""
    if isinstance(kind, StructType):
        parts = []
        for f in kind:
            value = x[f.name]
            if f.name in keys and isinstance(f.dataType, StringType):
                parts.append(F.coalesce(relative_path(value, folder), value).alias(f.name))
            else:
                parts.append(rewritten_keys(value, f.dataType, folder, keys).alias(f.name))
        return F.when(x.isNotNull(), F.struct(*parts))
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda v: rewritten_keys(v, kind.elementType, folder, keys))
    return x
