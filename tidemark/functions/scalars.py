"""Scalar functions as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction(s: Column) -> Column:
    """``"a/b"`` or a plain number as a double; null, nonsense and a zero denominator give 0."""
    parts = F.split(s, "/")
    a, b = parts[0].try_cast("double"), F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2)).try_cast("double")).otherwise(F.lit(1.0))
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def aspect(s: Column) -> Column:
    """``"a:b"`` as a ratio; nonsense and non-positive parts give 1."""
    a, b = F.try_element_at(F.split(s, ":"), F.lit(1)).try_cast("double"), F.try_element_at(F.split(s, ":"), F.lit(2)).try_cast("double")
    return F.when((a > 0) & (b > 0), a / b).otherwise(F.lit(1.0))


def without_comment(s: Column) -> Column:
    return F.trim(F.split_part(s, F.lit("#"), F.lit(1)))


def shortened(s: Column, most: int = 2000) -> Column:
    """The first ``most`` characters, as error messages are kept."""
    return F.left(s, F.lit(most))


def glob_needles(pattern: Column) -> Column:
    """What to look for in names for a glob: itself and its last part; the last part if only that is fixed;
    else what stands before the first star (nothing if the pattern begins with one)."""
    base = F.substring_index(pattern, "/", -1)
    before = F.regexp_replace(F.substring_index(pattern, "*", 1), "/$", "")
    return (
        F.when(~F.contains(pattern, F.lit("*")), F.array_distinct(F.array(pattern, base)))
        .when(~F.contains(base, F.lit("*")), F.array(base))
        .otherwise(F.filter(F.array(before), lambda x: x != ""))
    )


def local_stamp(at: Column, zone: str, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """A UTC time as it reads in ``zone`` (in a session whose time zone is UTC)."""
    return F.date_format(F.from_utc_timestamp(at, zone), pattern)


def at_least(width: Column, height: Column, least_width: float, least_height: float) -> Column:
    """A crop that is not degenerate."""
    return (width >= least_width) & (height >= least_height)


def number_pair(s: Column) -> Column:
    """``"a-b"`` as a struct of doubles, null if it is none."""
    a, b = F.regexp_extract(s, r"^\s*([0-9.]+)\s*-\s*([0-9.]+)\s*$", 1), F.regexp_extract(s, r"^\s*([0-9.]+)\s*-\s*([0-9.]+)\s*$", 2)
    return F.when(a != "", F.struct(a.try_cast("double").alias("low"), b.try_cast("double").alias("high")))


def signed_point(s: Column) -> Column:
    """``"x,y,+"`` as x, y and a sign of 1 for ``+`` or ``1``, else 0."""
    p = F.split(s, ",")
    return F.struct(p[0].try_cast("int").alias("x"), F.try_element_at(p, F.lit(2)).try_cast("int").alias("y"), F.when(F.coalesce(F.trim(F.try_element_at(p, F.lit(3))), F.lit("+")).isin("+", "1"), 1).otherwise(0).alias("sign"))


def stem(s: Column) -> Column:
    """Lower-case letters, digits and single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def tokens(s: Column, least: int = 6) -> Column:
    return F.filter(F.split(F.lower(s), "[^a-z0-9]+"), lambda t: F.length(t) >= least)


def clauses(s: Column, least: int = 12) -> Column:
    """Parts between commas and line ends, without ``{...}`` variables, blanks collapsed, short ones dropped."""
    parts = F.transform(F.split(s, "[,\n]"), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"\{[^}]*\}", ""), r"\s+", " ")))
    return F.filter(parts, lambda c: F.length(c) >= least)


def like_glob(s: Column, pattern: str) -> Column:
    """A glob if it has ``*``, ``?`` or ``[``, else a substring; both without case."""
    import re

    low = pattern.lower()
    if not set("*?[") & set(pattern):
        return F.contains(F.lower(s), F.lit(low))
    out = ""
    for part in re.split(r"(\*|\?|\[[^\]]*\])", low):
        out += {"*": "(?s:.*)", "?": "(?s:.)"}.get(part, part.replace("[!", "[^") if part.startswith("[") else re.escape(part))
    return F.lower(s).rlike(f"^{out}$")


def has_word(s: Column, needle: str) -> Column:
    import re

    return s.rlike(rf"(?i)(?<![A-Za-z0-9_]){re.escape(needle)}(?![A-Za-z0-9_])")


def tag(parts: Mapping[str, Column], prefix: str = "") -> Column:
    """Names of the parts that hold, joined by ``_``, with a prefix stripped."""
    names = F.concat_ws("_", *(F.when(on, F.lit(name)) for name, on in parts.items()))
    return F.when(F.startswith(names, F.lit(prefix)), F.substring(names, F.lit(len(prefix) + 1), F.length(names))).otherwise(names) if prefix else names


def parent_name(s: Column, drop: int = 2) -> Column:
    """A dotted key without its last ``drop`` parts."""
    p = F.split(s, r"\.")
    return F.array_join(F.slice(p, F.lit(1), F.greatest(F.lit(0), F.size(p) - drop)), ".")


def blank_to_null(s: Column) -> Column:
    return F.nullif(F.trim(s), F.lit(""))


def relative_path(s: Column, root: str) -> Column:
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(s, F.lit(base)), F.substring(s, F.lit(len(base) + 1), F.length(s))).otherwise(F.raise_error(F.concat(s, F.lit(f" is outside {root}"))))


def human_size(n: Column) -> Column:
    out = F.format_string("%.1f TiB", n / 1024.0**4)
    for unit, p in (("GiB", 3), ("MiB", 2), ("KiB", 1)):
        out = F.when(n < 1024 ** (p + 1), F.format_string(f"%.1f {unit}", n / float(1024**p))).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n.cast("long"))).otherwise(out)


def human_time(s: Column) -> Column:
    t = s.cast("long")
    h, m, x = F.floor(t / 3600), F.floor(t % 3600 / 60), t % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, x)).when(m > 0, F.format_string("%dm%02ds", m, x)).otherwise(F.format_string("%ds", x))


def f_score(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def guarded(a: Column, b: Column) -> Column:
    return a / (b + 1e-6)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def all_or_none(held: Column, total: Column) -> Column:
    return (held == 0) | (held == total)
