"""Scalar cleaners for listing text: prices, units, dates, booleans, labels.

All functions are Column -> Column built from Spark SQL expressions, so they
stay inside whole-stage codegen. Patterns over Polish text carry ``(?U)`` so
that ``\\w``, ``\\s`` and ``\\b`` are Unicode-aware (NBSP, ``ą``, ``ż``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carlot.schemas import AGE_BANDS, EXCHANGE_RATES, KW_TO_HP, POLISH_MONTHS, REFERENCE_YEAR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column) -> Column:
    return F.when(c == "", F.lit(None)).otherwise(c)


# --- text ------------------------------------------------------------------

def normalize_text(c) -> Column:
    """NBSP -> blank, collapse Unicode whitespace, strip; NULL -> ''."""
    c = F.coalesce(_c(c), F.lit(""))
    return F.trim(F.regexp_replace(F.regexp_replace(c, " ", " "), r"(?U)\s+", " "))


def strip(c) -> Column:
    """Strip Unicode whitespace at both ends (Python ``str.strip``)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def unknown_if_blank(c, label: str = "unknown") -> Column:
    """NULL or '' -> 'unknown' (grouping key of the example report)."""
    return F.coalesce(_blank_to_null(_c(c)), F.lit(label))


def nullify_blank(c) -> Column:
    return _blank_to_null(_c(c))


# --- numbers ---------------------------------------------------------------
# ``try_cast`` gives NULL for '', so no text is tested for it first: each test is the
# text's whole expression once more, and Java leaves methods of over 8000 bytes of code
# (which a projection of some such columns is) to its interpreter.

def digits_only(c) -> Column:
    """Drop every non-digit; NULL -> ''."""
    return F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\D+", "")


def clean_price(c, mode: str = "digits") -> Column:
    """Price text -> decimal(12,2).

    ``mode='digits'`` keeps every digit, so ``89 900,50`` -> 8990050 (the
    source application's behaviour); ``mode='decimal'`` reads the comma as
    the decimal mark (89900.50).
    """
    if mode == "decimal":
        compact = F.replace(F.regexp_replace(_c(c), r"(?U)\s+", ""), F.lit(","), F.lit("."))
        num = F.regexp_extract(compact, r"(\d+(?:\.\d+)?)", 1)
        return num.try_cast("decimal(12,2)")
    return digits_only(c).try_cast("decimal(12,2)")


def clean_int(c) -> Column:
    """All digits of the text as an int; none -> NULL."""
    return digits_only(c).try_cast("int")


clean_mileage = clean_int


def clean_engine_capacity(c) -> Column:
    """First run of digits/blanks (optionally followed by cm3/cm³/ccm) -> int.

    ``abc 1798`` -> 1798; ``ok silnik 1798`` -> NULL (the first run is one
    blank); ``1,8 l`` -> 1.
    """
    run = F.regexp_extract(F.lower(_c(c)), r"(?U)([\d\s]+)(?:cm3|cm³|ccm)?", 1)
    return digits_only(run).try_cast("int")


def clean_power_hp(c) -> Column:
    """Power text -> HP as int: kW x 1.35962, rounded half-even (90 kW -> 122)."""
    compact = F.lower(F.replace(F.replace(_c(c), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")))
    pat = r"(\d+(?:\.\d+)?)(kw|km|hp)?"
    num = F.regexp_extract(compact, pat, 1).try_cast("double")
    unit = F.regexp_extract(compact, pat, 2)
    hp = F.when(unit == "kw", num * F.lit(KW_TO_HP)).otherwise(num)
    return F.rint(hp).cast("int")


def legacy_price(c) -> Column:
    """Batch-CSV price: drop blanks, comma -> point, to double (bad -> NULL)."""
    return F.replace(F.replace(_c(c), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def first_number(c, drop: str | None = None) -> Column:
    """Strip a literal suffix and all whitespace, take the first ``\\d+`` as double."""
    c = _c(c)
    if drop:
        c = F.replace(c, F.lit(drop), F.lit(""))
    s = F.regexp_replace(c, r"(?U)\s+", "")
    return F.regexp_extract(s, r"(\d+)", 1).try_cast("double")


def engine_from_description(c) -> Column:
    """First ``<digits and blanks>cm3`` in free text -> int."""
    g = F.regexp_extract(_c(c), r"(\d[\d\s]*)cm3", 1)
    return F.regexp_replace(g, r"(?U)\s+", "").try_cast("int")


def power_from_description(c) -> Column:
    """First ``<digits> KM`` (case-sensitive) in free text -> int."""
    return F.regexp_extract(_c(c), r"(\d+)\s*KM", 1).try_cast("int")


def coerce_numeric(c, to: str = "double") -> Column:
    """Invalid -> NULL numeric coercion."""
    return _c(c).cast("string").try_cast(to)


# --- booleans ----------------------------------------------------------------

def tak_nie(c) -> Column:
    """'Tak' -> true, 'Nie' -> false (trimmed, any case), anything else -> NULL."""
    v = F.lower(strip(c))
    return F.when(v == "tak", F.lit(True)).when(v == "nie", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


# --- dates -------------------------------------------------------------------

def _month_map() -> Column:
    return F.create_map(*[x for i, m in enumerate(POLISH_MONTHS) for x in (F.lit(m), F.lit(i + 1))])


_DATE_PAT = r"(?U)^[\s\S]*?(\d{1,2})\s+(\w+)\s+(\d{4})(?:\s+(\d{1,2}):(\d{2}))?[\s\S]*$"


def _date_parts(c):
    """Day, month number, year, hour and minute text: one regex, its groups
    joined by a mark and split."""
    parts = F.split(F.regexp_replace(F.lower(_c(c)), _DATE_PAT, "$1\u0001$2\u0001$3\u0001$4\u0001$5"), "\u0001")
    matched = F.size(parts) == 5
    return parts, matched, F.try_element_at(_month_map(), F.get(parts, F.lit(1)))


def _date_of(parts, matched, month) -> Column:
    num = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    ts = F.try_make_timestamp_ntz(num(2), month, num(0), F.coalesce(num(3), F.lit(0)), F.coalesce(num(4), F.lit(0)), F.lit(0))
    return F.when(matched & month.isNotNull(), ts)


def polish_date(c) -> Column:
    """``d <genitive month> yyyy [HH:MM]`` -> timestamp_ntz; unknown month or
    impossible date -> NULL (see ``polish_date_rejected``)."""
    return _date_of(*_date_parts(c))


def polish_date_rejected(c) -> Column:
    """True when the text names a known month but the date does not exist
    (``32 maja 2026``); the source application raised and counted a parse error."""
    parts, matched, month = _date_parts(c)
    return F.coalesce(matched & month.isNotNull() & _date_of(parts, matched, month).isNull(), F.lit(False))


def any_date(c) -> Column:
    """Date text in the usual formats (ISO, with or without a time; day first
    with points, slashes or dashes; a Polish month name) -> date, else NULL."""
    s = F.trim(_c(c))
    iso = F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")
    day_first = F.try_to_date(F.regexp_replace(F.regexp_extract(s, r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}", 0), "[/-]", "."), "d.M.yyyy")
    return F.coalesce(iso, day_first, polish_date(s).cast("date"))


def month_replace_date(c) -> Column:
    """Batch-CSV date: replace month names by numbers, then the strict
    ``d m yyyy H:M`` format; any mismatch -> NULL."""
    s = _c(c)
    for i, m in enumerate(POLISH_MONTHS):
        s = F.replace(s, F.lit(m), F.lit(f"{i + 1:02d}"))
    return F.try_to_timestamp(s, F.lit("d M yyyy H:m")).cast("timestamp_ntz")


def scrape_date_stamp(run_date, days: int = 32) -> Column:
    """``run_date - days`` as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_sub(F.to_date(_c(run_date)), days), "yyyy-MM-dd")


# --- money and bands ----------------------------------------------------------

def rate_of(currency, rates: dict | None = None) -> Column:
    """PLN per unit of ``currency``; unknown -> 1. A literal map: no join."""
    rates = rates or EXCHANGE_RATES
    m = F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(m, _c(currency)), F.lit(1.0))


def to_pln(price, currency, op: str = "multiply", rates: dict | None = None) -> Column:
    """Price in PLN rounded half-even to a whole number.

    ``op='multiply'`` is the correct conversion (default); ``op='divide'``
    reproduces the analysis notebook, which divided by the rate.
    """
    r = rate_of(currency, rates)
    v = _c(price) * r if op == "multiply" else _c(price) / r
    return F.rint(v)


def age(year, reference_year: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - _c(year)


def age_band(age_col, bands=AGE_BANDS) -> Column:
    """Left-closed age bands; outside every band -> NULL."""
    a = _c(age_col)
    expr = None
    for lo, hi, label in bands:
        cond = (a >= lo) & (a < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def mileage_band(mileage, width: int = 50000) -> Column:
    """``000000-049999 km`` style band label."""
    lo = F.floor(_c(mileage) / width).cast("bigint") * width
    return F.format_string("%06d-%06d km", lo, lo + (width - 1))


def short_config(capacity_cm3, fuel, gearbox) -> Column:
    """``1.8 | B | M``: litres to one decimal (half-up), fuel and gearbox initials, '?' for NULL."""
    litres = F.round(_c(capacity_cm3).cast("decimal(12,4)") / 1000, 1).cast("decimal(12,1)").cast("string")
    ini = lambda c: F.coalesce(F.upper(F.substring(_c(c), 1, 1)), F.lit("?"))
    return F.concat_ws(" | ", F.coalesce(litres, F.lit("?")), ini(fuel), ini(gearbox))


def long_config(capacity_cm3, fuel, gearbox) -> Column:
    """``1798L | Diesel | Manualna`` with 'unknown' for NULL text."""
    return F.concat(F.coalesce(_c(capacity_cm3).cast("string"), F.lit("nan")), F.lit("L | "),
                    F.coalesce(_c(fuel), F.lit("unknown")), F.lit(" | "),
                    F.coalesce(_c(gearbox), F.lit("unknown")))


def model_label(make, model, sep: str = " ") -> Column:
    """``make<sep>model`` display label; NULL when either is NULL."""
    return F.concat(_c(make), F.lit(sep), _c(model))


def usage_per_year(median_mileage, year, reference_year: int = REFERENCE_YEAR) -> Column:
    """Median mileage / age, rounded half-even; age 0 -> NULL (no division error)."""
    return F.rint(F.try_divide(_c(median_mileage), F.lit(reference_year) - _c(year)))


# --- location ---------------------------------------------------------------

def city(location) -> Column:
    pat = r"^(.+?) \("
    return F.when(_c(location).rlike(pat), F.regexp_extract(_c(location), pat, 1))


def province(location) -> Column:
    pat = r"\((.*?)\)"
    return F.when(_c(location).rlike(pat), F.regexp_extract(_c(location), pat, 1))
