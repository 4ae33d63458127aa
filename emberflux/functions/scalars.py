"""Scalar operators as Column expressions: parsing, clamping, naming and estimating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as K


def normalize_alias(value: Column, aliases: dict) -> Column:
    """The canonical form of a known spelling, any other value unchanged."""
    table = F.create_map(*(F.lit(x) for pair in aliases.items() for x in (pair[0], str(pair[1]).lower() if isinstance(pair[1], bool) else pair[1])))
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(value))), value)


def parse_variables(text: Column) -> Column:
    """Names of a comma-separated list: trimmed, lower case, without quotes or empty entries."""
    names = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.transform(F.filter(names, lambda x: x != ""), lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), '^"+|"+$', ""), "^'+|'+$", ""))


def _canonical(names: Column) -> Column:
    return F.transform(names, lambda x: F.lower(F.trim(x)))


def variables_denied(names: Column, denied: tuple[str, ...]) -> Column:
    """True if the list is not empty and names nothing on the deny list."""
    return (F.size(names) > 0) & (F.size(F.array_intersect(_canonical(names), F.array(*map(F.lit, denied)))) == 0)


def variables_allowed(names: Column, allowed: tuple[str, ...]) -> Column:
    """True if the list is not empty and names only what is on the allow list."""
    return (F.size(names) > 0) & (F.size(F.array_except(_canonical(names), F.array(*map(F.lit, allowed)))) == 0)


def valid_coordinates(north: Column, west: Column, south: Column, east: Column) -> Column:
    return F.coalesce(north.between(-90, 90) & south.between(-90, 90) & west.between(-180, 180) & east.between(-180, 180) & (north > south), F.lit(False))


def validate_date(text: Column, month_form: bool = False) -> Column:
    """Whether a text is a date YYYY-MM-DD, or with month_form a month YYYY-MM."""
    day = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull()
    month = text.rlike(r"^\d{4}-\d{2}$") & F.try_to_timestamp(F.concat(text, F.lit("-01")), F.lit("yyyy-MM-dd")).isNotNull()
    return F.coalesce(day | month if month_form else day, F.lit(False))


def parse_date(text: Column, end: bool = False) -> Column:
    """A full date as it is; a month as its first day, or its last if it ends a range; else null."""
    whole = F.try_to_timestamp(F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).when(F.length(text) == 10, text), F.lit("yyyy-MM-dd")).cast("date")
    return F.when((F.length(text) == 7) & F.lit(end), F.last_day(whole)).otherwise(whole)


def clamp_end_date(end: Column, as_of: Column) -> Column:
    """No later than the provider's lag before as_of."""
    return F.least(end, F.date_sub(as_of, K.LAG_DAYS))


def format_nwse(n: Column, w: Column, s: Column, e: Column) -> Column:
    whole = lambda x: x.cast("int").cast("string")
    return F.concat(F.lit("N"), whole(n), F.lit("W"), whole(w), F.lit("S"), whole(s), F.lit("E"), whole(e))


def request_hash(dataset: Column, names: Column, bounds: Column) -> Column:
    """12 hex digits of the MD5 of dataset, sorted names and bounds in list notation."""
    quoted = F.concat(F.lit("['"), F.array_join(F.array_sort(names), "', '"), F.lit("']"))
    numbers = F.concat(F.lit("["), F.array_join(bounds.cast("array<string>"), ", "), F.lit("]"))
    return F.substring(F.md5(F.concat(dataset, F.lit("|"), quoted, F.lit("|"), numbers).cast("binary")), 1, 12)


def format_duration(seconds: Column) -> Column:
    s = F.greatest(seconds, F.lit(0.0))
    whole = F.floor(s).cast("long")
    d, h, m = F.floor(s / 86400).cast("long"), F.floor(s / 3600).cast("long"), F.floor((whole % 3600) / 60).cast("long")
    rest = F.bround(s % 60, 2)
    return (
        F.when(d > 0, F.format_string("%dd %dh %dm %.2fs", d, h % 24, m, rest))
        .when(h > 0, F.format_string("%dh %dm %.2fs", h, m, rest))
        .when(m > 0, F.format_string("%dm %.2fs", m, rest))
        .otherwise(F.format_string("%.5fs", F.bround(s % 60, 5)))
    )


def _span(west: Column, east: Column) -> Column:
    return F.when(east > west, east - west).otherwise(360 + east - west)


def estimate_file_size(n_variables: Column, n: Column, w: Column, s: Column, e: Column, resolution: Column, hours: Column) -> Column:
    """MB of one month's extract; 0 without variables."""
    scale = (n_variables / K.SIZE_VARIABLES) * ((n - s) * _span(w, e) / K.SIZE_DEGREES) * F.pow(K.SIZE_RESOLUTION / resolution, F.lit(2.0)) / hours
    return F.when(n_variables > 0, F.round(F.greatest(K.SIZE_MB * scale, F.lit(K.SIZE_LEAST_MB)), 3)).otherwise(0.0)


def estimate_month_seconds(n_variables: Column, n: Column, w: Column, s: Column, e: Column, resolution: Column, hours: Column, days: Column, mbps: Column) -> Column:
    """Seconds that one month's request is expected to take."""
    cells = F.greatest(F.ceil(F.greatest(n - s, F.lit(0.0)) / resolution), F.lit(1)) * F.greatest(F.ceil(_span(w, e) / resolution), F.lit(1))
    units = cells * F.floor(24 / hours * days) * F.greatest(n_variables, F.lit(1))
    line = F.least(F.greatest(mbps / 8, F.lit(0.5)), F.lit(K.SERVER_MBPS / 8))
    return (K.BASE_SECONDS + units / K.UNITS_PER_SECOND + estimate_file_size(n_variables, n, w, s, e, resolution, hours) / line) * K.SAFETY


def parallel_seconds(total: Column, workers: Column) -> Column:
    return total / (F.greatest(workers, F.lit(1)) * K.PARALLEL_EFFICIENCY)


def clamp_settings(retries: Column, delay: Column, parallel: Column) -> tuple[Column, Column, Column]:
    return F.least(F.greatest(retries, F.lit(0)), F.lit(K.MOST_RETRIES)), F.least(F.greatest(delay, F.lit(0)), F.lit(K.MOST_DELAY)), F.least(F.greatest(parallel, F.lit(1)), F.lit(K.MOST_PARALLEL))


def extract_bounds(config: Column) -> Column:
    """[north, west, south, east] of a JSON config: a list or an object, under several names, or top-level keys."""
    number = lambda path: F.get_json_object(config, path).cast("double")

    def of(paths: list[str]) -> Column:
        parts = [number(p) for p in paths]
        found = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull() & parts[3].isNotNull()
        return F.when(found, F.array(*parts))

    tries = []
    for key in ("region_bounds", "bounds", "area"):
        tries += [of([f"$.{key}[{i}]" for i in range(4)]), of([f"$.{key}.{x}" for x in ("north", "west", "south", "east")]), of([f"$.{key}.{x}" for x in "nwse"])]
    return F.coalesce(*tries, of([f"$.{x}" for x in ("north", "west", "south", "east")]))


def month_file_name(prefix: str, month: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(month, "yyyy_MM"), F.lit(".parquet"))


def combined_file_name(prefix: str, first: Column, last: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(first, "yyyy-MM"), F.lit("_"), F.date_format(last, "yyyy-MM"), F.lit(".parquet"))


def confidence_label(r: Column) -> Column:
    return F.when(r >= K.CONFIDENCE_HIGH, "high").when(r >= K.CONFIDENCE_LOW, "medium").when(r.isNotNull(), "low")


def convert_zone(ts: Column, to: str = "Asia/Kolkata") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(to), ts)
