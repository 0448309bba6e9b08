"""Schemas and presets.

The blocks marked FIXED VALUES hold literals that must equal the source
application's vocabulary for results to agree (labels, month names, section
headers, markers). They are kept together, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: listing-site vocabulary
# ---------------------------------------------------------------------------

# Parameter labels accepted from offer pages (supported path).
FIELD_LABELS = (
    "Marka pojazdu",
    "Model pojazdu",
    "Wersja",
    "Rok produkcji",
    "Rodzaj paliwa",
    "Skrzynia biegów",
    "Typ nadwozia",
    "Moc",
    "Pojemność skokowa",
    "Przebieg",
)

# Parameter labels of the batch CSV export (37), in export order.
BATCH_LABELS = (
    "Marka pojazdu", "Model pojazdu", "Wersja", "Kolor", "Liczba drzwi", "Liczba miejsc",
    "Rok produkcji", "Generacja", "Rodzaj paliwa", "Pojemność skokowa", "Moc",
    "Typ nadwozia", "Rodzaj koloru", "Skrzynia biegów", "Napęd", "Emisja CO2",
    "Spalanie W Mieście", "Spalanie Poza Miastem", "Kraj pochodzenia", "Przebieg",
    "Numer rejestracyjny pojazdu", "Stan", "Bezwypadkowy",
    "Data pierwszej rejestracji w historii pojazdu", "Zarejestrowany w Polsce",
    "Pierwszy właściciel (od nowości)", "Serwisowany w ASO", "Ma numer rejestracyjny",
    "Pojemność baterii", "Autonomia", "Średnie zużycie", "Kondycja baterii",
    "Typ złącza ładowania", "Elektryczna moc maksymalna HP", "Liczba silników",
    "Odzyskiwanie energii hamowania", "Liczba baterii",
)

# Trailing columns of the batch CSV export, after the labels.
BATCH_TAIL = ("equipment", "price", "currency", "price_level", "advert_date", "advert_id", "description")

# data-testid wrappers the threaded variant maps straight to a label.
TESTID_TO_LABEL = {
    "registration": "Numer rejestracyjny pojazdu",
    "date_registration": "Data pierwszej rejestracji w historii pojazdu",
}

# Raw label -> record column, for the labels copied as text.
LABEL_TO_COLUMN = {
    "Marka pojazdu": "make",
    "Model pojazdu": "model",
    "Wersja": "version",
    "Rok produkcji": "production_year",
    "Rodzaj paliwa": "fuel_type",
    "Skrzynia biegów": "transmission",
    "Typ nadwozia": "body_type",
}

# data-testid wrappers that never hold a label/value pair.
SKIP_TESTIDS = (
    "basic_information",
    "technical_specs",
    "condition_history",
    "financial_information",
    "collapsible-groups-wrapper",
)

# Polish month names in the genitive, January..December.
POLISH_MONTHS = (
    "stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca",
    "lipca", "sierpnia", "września", "października", "listopada", "grudnia",
)

# Page-text markers of a blocked (captcha) page.
CAPTCHA_MARKERS = ("captcha", "are you human", "potwierdź, że nie jesteś robotem")
CAPTCHA_MARKERS_LEGACY = ("captcha", "too many requests")

# Equipment section headers that are not equipment items.
EQUIPMENT_SECTIONS = (
    "audio i multimedia",
    "komfort i dodatki",
    "systemy wspomagania kierowcy",
    "bezpieczeństwo",
)

# Conversion factor kW -> HP.
KW_TO_HP = 1.35962

# Exchange rates of the analysis notebook (PLN per unit).
EXCHANGE_RATES = {"EUR": 4.28, "PLN": 1.0}

# Age bands [lo, hi) with their labels.
AGE_BANDS = ((0, 5, "0–4"), (5, 10, "5–9"), (10, 15, "10–14"), (15, 20, "15–19"), (20, 26, "20–25"))

# Reference year of the analysis notebook.
REFERENCE_YEAR = 2025

# Batch-CSV Polish -> English rename map (the cleaned-measure columns keep their names).
RENAME_MAP = {
    "Marka pojazdu": "make", "Model pojazdu": "model", "Wersja": "version",
    "Kolor": "color", "Liczba drzwi": "number_of_doors", "Liczba miejsc": "number_of_seats",
    "Rok produkcji": "production_year", "Generacja": "generation", "Rodzaj paliwa": "fuel_type",
    "Typ nadwozia": "body_type", "Rodzaj koloru": "color_type", "Skrzynia biegów": "transmission",
    "Napęd": "drive_type", "Kraj pochodzenia": "country_of_origin",
    "Numer rejestracyjny pojazdu": "registration_number",
    "Stan": "condition", "Bezwypadkowy": "accident_free",
    "Data pierwszej rejestracji w historii pojazdu": "first_registration_date",
    "Zarejestrowany w Polsce": "registered_in_poland", "Pierwszy właściciel (od nowości)": "first_owner",
    "Serwisowany w ASO": "serviced_at_authorized_station", "Ma numer rejestracyjny": "has_registration_number",
    "Typ złącza ładowania": "charging_connector_type", "Liczba silników": "number_of_engines",
    "Odzyskiwanie energii hamowania": "brake_energy_recovery", "Liczba baterii": "number_of_batteries",
}

# Typed-cast spec of the batch CSV (after renaming).
CAST_SPEC = {
    "number_of_doors": "tinyint", "number_of_seats": "tinyint", "production_year": "smallint",
    "number_of_engines": "tinyint", "number_of_batteries": "tinyint", "mileage_km": "int",
    "advert_id": "bigint",
    "price": "float", "battery_capacity_kwh": "float", "range_km": "float",
    "power_hp": "float", "co2_emissions_gpkm": "float", "urban_fuel_consumption_l_per_100km": "float",
    "extraurban_fuel_consumption_l_per_100km": "float", "average_energy_consumption_kwh_per_100km": "float",
    "battery_health_percent": "float", "max_electric_power_hp": "float", "engine_capacity_cm3": "float",
    "accident_free": "boolean", "registered_in_poland": "boolean", "first_owner": "boolean",
    "serviced_at_authorized_station": "boolean", "has_registration_number": "boolean",
    "brake_energy_recovery": "boolean",
    "make": "string", "model": "string", "version": "string", "color": "string", "generation": "string",
    "fuel_type": "string", "body_type": "string", "color_type": "string", "transmission": "string",
    "drive_type": "string", "country_of_origin": "string", "condition": "string",
    "charging_connector_type": "string", "currency": "string", "price_level": "string",
}
DATE_SPEC = {"first_registration_date": "date", "advert_date": "timestamp"}

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------

PAGES_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("retry_after", T.StringType()),
    T.StructField("seq", T.LongType()),
])

RAW_LISTING_SCHEMA = T.StructType([
    T.StructField("advert_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("raw_fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("equipment", T.ArrayType(T.StringType())),
    T.StructField("price_raw", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("advert_date_raw", T.StringType()),
])

LISTING_SCHEMA = T.StructType([
    T.StructField("advert_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("source_url", T.StringType(), False),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("production_year", T.IntegerType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("mileage_km", T.IntegerType()),
    T.StructField("fuel_type", T.StringType()),
    T.StructField("transmission", T.StringType()),
    T.StructField("body_type", T.StringType()),
    T.StructField("power_hp", T.IntegerType()),
    T.StructField("engine_capacity_cm3", T.IntegerType()),
    T.StructField("advert_date", T.TimestampNTZType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("equipment", T.ArrayType(T.StringType())),
    T.StructField("raw_parameters", T.MapType(T.StringType(), T.StringType())),
])

# Columns the keyed upsert overwrites from the incoming record.
UPSERT_COLUMNS = (
    "source_url", "make", "model", "version", "production_year", "price", "currency",
    "mileage_km", "fuel_type", "transmission", "body_type", "power_hp",
    "engine_capacity_cm3", "advert_date", "scraped_at", "equipment", "raw_parameters",
)
