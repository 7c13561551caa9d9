"""Column-expression builders for string parsing and simple numeric remaps.

Everything here returns a ``Column`` made of built-in SQL functions (codegen'd, no Python per
row); multi-part strings are handled with higher-order functions (``transform``/``aggregate``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values of the laptop parsing rules: storage kinds, the terabyte marker and its factor, the
# default for an empty company. The OS names and CPU patterns stand where they are used.
STORAGE_KINDS = ("ssd", "hdd", "flash")
TERABYTE_MARK, GB_PER_TB = "tb", 1024.0
UNKNOWN_COMPANY = "UNKNOWN_COMPANY"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_number(s: Column, dtype: str = "double") -> Column:
    """String → number; unparsable or empty gives null (``try_cast``, ANSI-safe)."""
    return s.try_cast(dtype)


def lower_trim(s: Column | str) -> Column:
    return F.trim(F.lower(_c(s)))


def default_if_empty(s: Column | str, default: str = UNKNOWN_COMPANY) -> Column:
    """Lower-cased, trimmed string; an empty one becomes ``default``."""
    v = lower_trim(s)
    return F.when(F.length(v) > 0, v).otherwise(F.lit(default))


def parse_storage(s: Column | str) -> Column:
    """``'128GB SSD +  1TB HDD'`` → struct(ssd_gb, hdd_gb, flash_gb, total_storage_gb).

    Parts are separated by ``' + '``; each part's first number is its size, multiplied by 1024 when
    the part mentions ``tb``; the size counts towards ssd / hdd / flash when the part names the
    kind. Other kinds (``hybrid``) add 0 everywhere. Total = ssd + hdd + flash.
    """
    parts = F.split(F.lower(_c(s)), r" \+ ")

    def size(p: Column) -> Column:
        n = F.coalesce(to_number(F.regexp_extract(p, r"([0-9.]+)", 1)), F.lit(0.0))
        return n * F.when(p.contains(TERABYTE_MARK), F.lit(GB_PER_TB)).otherwise(F.lit(1.0))

    def total(kind: str) -> Column:
        return F.aggregate(parts, F.lit(0.0),
                           lambda acc, p: acc + F.when(p.contains(kind), size(p)).otherwise(F.lit(0.0)))

    ssd, hdd, flash = (total(k) for k in STORAGE_KINDS)
    return F.struct(ssd.alias("ssd_gb"), hdd.alias("hdd_gb"), flash.alias("flash_gb"),
                    (ssd + hdd + flash).alias("total_storage_gb"))


def parse_unit(s: Column | str, unit: str) -> Column:
    """``'8GB'`` → 8.0, ``'1.37kg'`` → 1.37: lower-case, drop the unit, parse (case-insensitive)."""
    return to_number(F.trim(F.regexp_replace(F.lower(_c(s)), unit.lower(), "")))


def map_os(s: Column | str) -> Column:
    """Canonical OS: contains 'windows' → windows, contains 'mac' → macos, else the lowered input."""
    v = lower_trim(s)
    return F.when(v.contains("windows"), "windows").when(v.contains("mac"), "macos").otherwise(v)


def parse_resolution(s: Column | str) -> Column:
    """struct(width, height) from the first ``WIDTHxHEIGHT`` (3-5 digits each); null when absent.

    The first complete match is used, so ``full hd 1920x1080`` gives 1920, not 920.
    """
    v = lower_trim(s)
    pat = r"(\d{3,5})x(\d{3,5})"
    return F.struct(to_number(F.regexp_extract(v, pat, 1)).alias("width"),
                    to_number(F.regexp_extract(v, pat, 2)).alias("height"))


def flag_contains(s: Column | str, keyword: str) -> Column:
    """1.0 when the lowered string contains ``keyword`` literally, else 0.0."""
    return lower_trim(s).contains(keyword.lower()).cast("float")


def parse_cpu(s: Column | str) -> Column:
    """struct(brand, family, clock_ghz) from a CPU description.

    brand: intel when the text mentions intel, else amd; family: the text without the brand word
    and from the first space-then-digit on; clock: the number right before ``ghz``.
    """
    v = lower_trim(s)
    brand = F.when(v.contains("intel"), "intel").otherwise("amd")
    family = F.regexp_replace(F.regexp_replace(v, r"^(intel|amd)\s+", ""), r"\s+\d.*", "")
    clock = to_number(F.regexp_extract(v, r"([\d.]+)\s*ghz", 1), "float")
    return F.struct(brand.alias("brand"), family.alias("family"), clock.alias("clock_ghz"))


def token_at(s: Column | str, i: int, sep: str = " ") -> Column:
    """i-th token (0-based) of the lowered, trimmed string split on ``sep``; '' when absent."""
    return F.coalesce(F.get(F.split(lower_trim(s), sep), F.lit(i)), F.lit(""))


def bucketize(x: Column | str, edges: list[float]) -> Column:
    """Index of the first edge the value is below (``len(edges)`` when above all), as float."""
    v = _c(x)
    expr = F.lit(float(len(edges)))
    for i in reversed(range(len(edges))):
        expr = F.when(v < F.lit(edges[i]), F.lit(float(i))).otherwise(expr)
    return expr.cast("float")


def affine(x: Column | str, scale: float = 1.0, shift: float = 0.0) -> Column:
    """(x + shift) * scale: ``/255`` is scale=1/255, ``x-1`` shift=-1, ``(x-1)*127`` both."""
    return (_c(x) + F.lit(shift)) * F.lit(scale)
