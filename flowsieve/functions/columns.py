"""Column functions on payment rows; none of them shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm"


def lenient_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Parse text; anything unreadable becomes NULL."""
    return F.try_to_timestamp(text, F.lit(fmt))


def hour_or_missing(ts: Column) -> Column:
    return F.coalesce(F.hour(ts), F.lit(-1))


def weekday_or_missing(ts: Column) -> Column:
    """Monday is 0, a missing time is -1."""
    return F.coalesce(F.weekday(ts), F.lit(-1))


def weekend_flag(ts: Column) -> Column:
    return weekday_or_missing(ts).isin(5, 6).cast("int")


def log_amount(amount: Column) -> Column:
    """log1p of the amount clipped at zero, NULL stays NULL."""
    return F.when(amount.isNotNull(), F.log1p(F.greatest(amount, F.lit(0.0))))


def log10_amount(amount: Column, floor: float = 1e-4) -> Column:
    return F.when(amount.isNotNull(), F.log10(F.greatest(amount, F.lit(floor))))


def same_flag(a: Column, b: Column) -> Column:
    """1 when both are known and equal, else 0."""
    return F.coalesce(a == b, F.lit(False)).cast("int")


def account_key(bank: Column, account: Column) -> Column:
    """Bank and account; NULL when either is missing, so that such payments never share an account."""
    return F.concat(bank.cast("string"), F.lit("_"), account)


def finite_or_zero(x: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    inf = float("inf")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(inf))
    return F.when(bad, F.lit(0.0)).otherwise(x)


def log_abs(x: Column) -> Column:
    return F.log1p(F.abs(x))


def money(x: Column) -> Column:
    """Amounts are summed as decimals, so totals do not depend on row order."""
    return x.cast(MONEY)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def slug(text: Column) -> Column:
    """File-name form of a label: lower case, blank -> underscore, plus sign -> 'plus'."""
    return F.replace(F.replace(F.lower(text), F.lit(" "), F.lit("_")), F.lit("+"), F.lit("plus"))


def relabel(text: Column, names: dict[str, str]) -> Column:
    """Replace known values, keep the others."""
    chain = reduce(
        lambda acc, kv: acc.when(text == kv[0], F.lit(kv[1])), list(names.items())[1:],
        F.when(text == next(iter(names)), F.lit(next(iter(names.values())))),
    )
    return chain.otherwise(text)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def draw_hash(key: Column, seed: int) -> Column:
    """Reproducible draw for a row: the same key and seed give the same hex text anywhere."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), key.cast("string")).cast("binary"))


def draw_uniform(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) from the first 7 hex digits of the draw hash."""
    return F.conv(F.substring(draw_hash(key, seed), 1, 7), 16, 10).cast("double") / F.lit(float(16**7))


def params_json(params: dict) -> Column:
    """Parameter map as JSON text with sorted keys."""
    parts = [F.lit(str(k)).alias("key") for k in sorted(params)]
    pairs = [F.struct(k, F.lit(str(params[n])).alias("value")) for k, n in zip(parts, sorted(params))]
    return F.to_json(F.map_from_entries(F.array(*pairs)))
