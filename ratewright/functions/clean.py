"""Column expressions for cleaning and small formulas.  All are built-in functions; none is a UDF."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_WORDS = ("", "nan", "none", "null", "na", "n/a", "<na>", "nat")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")


@cache
def ascii_forms() -> dict[str, str]:
    """Every other character whose compatibility decomposition has ASCII characters, and those."""
    found = ((chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    return {c: form for c, form in found if form}


@cache
def ascii_letters() -> tuple[str, str]:
    """The characters with one ASCII character as their form, and those, in the same order."""
    single = {c: form for c, form in ascii_forms().items() if len(form) == 1 and ord(c) < 0x10000}
    return "".join(single), "".join(single.values())


@cache
def ascii_spellings() -> tuple[dict[str, str], str, str]:
    """The other characters with their forms, a pattern for any of them, and a cheap one that all of them fit, and few Latin texts."""
    several = {c: form for c, form in ascii_forms().items() if c not in ascii_letters()[0]}
    ranges: list[list[int]] = []
    for c in map(ord, several):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    written = lambda found: "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in found) + "]"
    return several, written(ranges), written([r for r in ranges if r[1] < 0x2000] + [[0x2000, 0x10FFFF]])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_scalar(c: Column | str) -> Column:
    """Trimmed text; words for nothing become null; an integer-like number loses its `.0`."""
    text = F.trim(_col(c).cast("string"))
    return F.when(F.lower(text).isin(*NULL_WORDS), None).otherwise(F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"))


def blank_to_null(c: Column | str) -> Column:
    text = F.trim(_col(c).cast("string"))
    return F.when(text == "", None).otherwise(text)


def coalesce_columns(*columns: Column | str) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*map(blank_to_null, columns))


def normalize_code(c: Column | str, aliases: dict[str, str]) -> Column:
    """Upper-cased code through an alias map; unknown codes stay, blank ones are null."""
    code = F.upper(blank_to_null(c))
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    return F.coalesce(F.try_element_at(table, code), code)


def fold_ascii(c: Column | str) -> Column:
    """Lower-case ASCII: characters become the ASCII part of their compatibility decomposition (`\u00e9` e, `\ufb01` fi), what has none is dropped.

    Only texts with characters of several letters go through an array of characters.
    """
    text, (letters, plain), (several, exact, cheap) = _col(c), ascii_letters(), ascii_spellings()
    table = F.create_map(*(F.lit(x) for kv in several.items() for x in kv))
    spelled = F.array_join(F.transform(F.split(text, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    whole = F.when(text.rlike(cheap) & text.rlike(exact), spelled).otherwise(text)
    return F.regexp_replace(F.lower(F.translate(whole, letters, plain)), r"[^\x00-\x7F]", "")


def normalize_name(c: Column | str, keep_suffix: bool = False) -> Column:
    """Folded words of letters and digits joined by single spaces, without a generation suffix."""
    words = F.trim(F.regexp_replace(F.regexp_replace(fold_ascii(c), r"['.]", ""), r"[^a-z0-9]+", " "))
    return words if keep_suffix else F.regexp_replace(words, rf" ({'|'.join(SUFFIXES)})$", "")


def compact_name(c: Column | str) -> Column:
    return F.replace(normalize_name(c), F.lit(" "), F.lit(""))


def initial_last(c: Column | str) -> Column:
    """First letter and last word, such as `j.smith`; null for a single word."""
    parts = F.split(normalize_name(c), " ")
    return F.when(F.size(parts) > 1, F.concat(F.substring(parts[0], 1, 1), F.lit("."), F.element_at(parts, -1)))


def alias_list(*columns: Column | str) -> Column:
    """Distinct non-blank values in column order, joined by a pipe."""
    return F.array_join(F.array_distinct(F.array_compact(F.array(*map(blank_to_null, columns)))), "|")


def normalize_date(c: Column | str) -> Column:
    """ISO date of anything that parses as one of the common forms, else the text as it is."""
    text = blank_to_null(c)
    parsed = F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd")))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), text)


def safe_divide(a: Column | str, b: Column | str, default: float | None = None) -> Column:
    """a / b; `default` where either is null or b is 0."""
    out = F.when(_col(b) != 0, _col(a).cast("double") / _col(b))
    return out if default is None else F.coalesce(out, F.lit(default))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Null stays null (greatest and least would drop it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def implied_probability(price: Column | str) -> Column:
    """Of an American price: -110 gives 110/210, +150 gives 100/250."""
    p = _col(price).cast("double")
    return F.when(p < 0, -p / (-p + 100)).when(p > 0, 100 / (p + 100))


def net_profit(price: Column | str) -> Column:
    """Profit of one unit staked at an American price."""
    p = _col(price).cast("double")
    return F.when(p < 0, 100 / -p).when(p > 0, p / 100)


def sane_price(price: Column | str, fallback: float = -110.0) -> Column:
    """An American price of at least 100 in size, else the fallback."""
    p = _col(price).cast("double")
    return F.when(F.abs(p) >= 100, p).otherwise(F.lit(fallback))


# Abramowitz and Stegun 26.2.17: fixed values
_CDF = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_cdf(x: Column | str) -> Column:
    """Standard normal distribution function, absolute error below 7.5e-8 (Spark has no erf)."""
    x = _col(x).cast("double")
    t = 1 / (1 + 0.2316419 * F.abs(x))
    poly = reduce(lambda acc, b: t * (F.lit(b) + acc), reversed(_CDF), F.lit(0.0))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(x >= 0, 1 - upper).otherwise(upper)


def cover_and_kelly(edge: Column | str, shift: float, sigma: float, price: Column | str, fraction: float = 0.25, cap: float = 0.05) -> dict[str, Column]:
    """Probability that an edge covers, what the price needs, the capped fractional Kelly stake and a decision."""
    edge, probability = _col(edge), normal_cdf((F.abs(_col(edge)) + shift) / sigma)
    need, profit = implied_probability(price), net_profit(price)
    kelly = (probability * profit - (1 - probability)) / profit
    stake = F.least(F.greatest(kelly * fraction, F.lit(0.0)), F.lit(cap))
    decision = F.when(edge.isNull(), "no line").when(probability <= need, "pass").when(F.abs(edge) < 2, "lean").otherwise("play")
    return {"cover_probability": probability, "break_even": need, "kelly_stake": stake, "decision": decision}


def rest_points(own: Column | str, other: Column | str, cap: float = 2.0) -> Column:
    """Half a point for each day of rest more than the other side, capped both ways."""
    return clip((_col(own) - _col(other)) * 0.5, -cap, cap)


def factor_points(factors: dict[str, tuple[Column, float]], cap: float) -> tuple[Column, Column]:
    """Capped sum of the points of the factors that hold, and their names joined by a pipe."""
    total = reduce(lambda a, b: a + b, [F.when(c, F.lit(p)).otherwise(0.0) for c, p in factors.values()])
    reasons = F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, (c, _) in factors.items()))), "|")
    return clip(total, -cap, cap), reasons


def availability(status: Column | str, out=("out", "ir", "pup", "suspended", "inactive"), doubt=("doubtful", "questionable")) -> Column:
    text = F.lower(blank_to_null(status))
    return F.when(text.isin(*out) | text.rlike("injured reserve|non-football"), "unavailable").when(text.isin(*doubt), "uncertain").otherwise("available")


def latest_injury(injuries: Column | str) -> Column:
    """The newest dated element of array<struct<date, status>> (ties: the greater status)."""
    return F.array_max(_col(injuries)).getField("status")


def age_minutes(ts: Column | str, now: Column | str) -> Column:
    """Minutes from `ts` to `now`."""
    return (F.unix_micros(_col(now)) - F.unix_micros(_col(ts))) / 60_000_000


def parse_price_text(c: Column | str) -> Column:
    """A spread token read from an image: sign, digits and a half (a half sign, or a common misreading of it); PK is 0."""
    text = F.upper(F.replace(blank_to_null(c), F.lit(" "), F.lit("")))
    fixed = F.translate(text, "AOIL½¥%)", "4011\x01\x01\x01\x01")
    sign = F.when(fixed.startswith("-"), -1.0).otherwise(1.0)
    digits = F.regexp_extract(fixed, r"^[+-]?(\d{1,2})", 1)
    half = fixed.rlike("\x01|[.]5|Y")
    return F.when(text.isin("PK", "PICK", "EVEN"), 0.0).when(digits != "", sign * (digits.cast("int") + F.when(half, 0.5).otherwise(0.0)))


def spread_label(team: Column | str, other: Column | str, margin: Column | str) -> Column:
    """`A -3.5`: the favourite by an expected margin of `team`, or pick'em."""
    m = _col(margin)
    return F.when(m.isNull(), None).when(m == 0, "pick'em").otherwise(F.concat(F.when(m > 0, _col(team)).otherwise(_col(other)), F.format_string(" -%.1f", F.abs(m).cast("double"))))
