"""Seed relations (S8): countries, the order-status map and manual rates.

The lists below are fixed values that the warehouse must reproduce exactly;
they are kept as written, in their original order, including trailing
spaces and one mis-encoded key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values: (country_name, country_code, currency_code).
COUNTRIES = [
    ("Bulgaria", "BG", "BGN"),
    ("Colombia", "CO", "COP"),
    ("Croatia", "HR", "EUR"),
    ("Denmark", "DK", "DKK"),
    ("Finland", "FI", "EUR"),
    ("Hungary", "HU", "HUF"),
    ("Italy", "IT", "EUR"),
    ("Lithuania", "LT", "EUR"),
    ("Norway", "NO", "NOK"),
    ("Poland", "PL", "PLN"),
    ("Romania", "RO", "RON"),
    ("Serbia", "RS", "RSD"),
    ("Spain", "ES", "EUR"),
    ("Sweden", "SE", "SEK"),
]

# Country-code aliases accepted on input.
COUNTRY_ALIASES = {"PO": "PL"}

BASE_CURRENCY = "EUR"

# Raw order status -> standard status, as listed at the source.
STATUS_MAP = [
    ("Ny (ubekræftet)", "NEW"),
    ("Ny (ubekreftet)", "NEW"),
    ("1. Nuevo (sin confirmar)", "NEW"),
    ("Nuevo (sin confirmar)", "NEW"),
    ("Novo", "NEW"),
    ("Naujas (nepatvirtintas)", "NEW"),
    ("Új (nem visszaigazolt)", "NEW"),
    ("Nuovo (non confermato)", "NEW"),
    ("Ordre bekreftet", "CONFIRMED"),
    ("2. Confirmado", "CONFIRMED"),
    ("2. Confirmata", "CONFIRMED"),
    ("Ordine confermato (in lavorazione)", "CONFIRMED"),
    ("Tilaus vahvistettu", "CONFIRMED"),
    ("Vahvistettu alustavalla toimituspäivällä", "CONFIRMED"),
    ("Bekräftad med preliminärt sändningsdatum", "CONFIRMED"),
    ("Novo potvrdjeno (čeka se realizacija)", "CONFIRMED"),
    ("Nuevo confirmado (pendiente de finalizar)", "CONFIRMED"),
    ("Patvirtintas, vykdomas", "CONFIRMED"),
    ("Under behandling", "PROCESSING"),
    ("I prosess", "PROCESSING"),
    ("Ð’ Ð¿Ñ€Ð¾Ñ†ÐµÑ", "PROCESSING"),
    ("Folyamatban", "PROCESSING"),
    ("In corso", "PROCESSING"),
    ("Merce in preparazione", "PROCESSING"),
    ("En proceso", "PROCESSING"),
    ("En proceso - tienda", "PROCESSING"),
    ("In progress (Change stock internal)", "PROCESSING"),
    ("W trakcie realizacji (ERP)", "PROCESSING"),
    ("Packas", "PROCESSING"),
    ("Käsittelyssä", "PROCESSING"),
    ("Ordine completato", "PROCESSING"),
    ("Listo para ser enviado", "READY_TO_SHIP"),
    ("4. Listo para enviar", "READY_TO_SHIP"),
    ("Klar til å bli sendt", "READY_TO_SHIP"),
    ("Klar til å bli sendt ", "READY_TO_SHIP"),
    ("Ruošiamas išsiuntimui", "READY_TO_SHIP"),
    ("Ruošiamas atsiėmimui", "READY_TO_SHIP"),
    ("Spremno za dostavu/preuzimanje", "READY_TO_SHIP"),
    ("Szállításra kész", "READY_TO_SHIP"),
    ("Üzletben átvehető", "READY_TO_SHIP"),
    ("5. Enviado", "SHIPPED"),
    ("ordine spedito parzialmente", "SHIPPED"),
    ("Bestillingen er fullført", "COMPLETED"),
    ("Ordre afsluttet", "COMPLETED"),
    ("Ordre afsluttet ", "COMPLETED"),
    ("Ordre avsluttet", "COMPLETED"),
    ("Beställning slutförd", "COMPLETED"),
    ("Pedido completado", "COMPLETED"),
    ("Orden completada", "COMPLETED"),
    ("Užsakymas įvykdytas", "COMPLETED"),
    ("Porudžbina realizovana", "COMPLETED"),
    ("Narudžba zaključena", "COMPLETED"),
    ("Narudžba zaključena ", "COMPLETED"),
    ("Zamówienie zrealizowane      ", "COMPLETED"),
    ("Zamówienie zakończone ", "COMPLETED"),
    ("Megrendelés befejezve", "COMPLETED"),
    ("TILAUS VALMIS", "COMPLETED"),
    ("5. Livrata", "COMPLETED"),
    ("6. Pedido cancelado", "CANCELLED"),
    ("Ordine cancellato", "CANCELLED"),
    ("ordine annullato", "CANCELLED"),
    ("Anulowane - przelew zrealizowany", "CANCELLED"),
    ("Törölt rendelés – dupla rendelés", "CANCELLED"),
    ("Zamówienie anulowane- zdublowane  ", "CANCELLED"),
    ("Zamówienie anulowane- zdublowane", "CANCELLED"),
    ("7. Retur", "RETURN"),
    ("7. Devolución", "RETURN"),
    ("Devolución", "RETURN"),
    ("Zwrot ", "RETURN"),
    ("Zwrot", "RETURN"),
    ("Grąžinimas", "RETURN"),
    ("PALAUTUS", "RETURN"),
    ("Ritorno", "RETURN"),
    ("Retur - Mottatt lager", "RETURN"),
    ("Zwrot przyjęty na magazynie   ", "RETURN"),
    ("Zwrot brak przyjęcia towaru  ", "RETURN"),
    ("Zwrot - przekazane do działu księgowości", "RETURN"),
    ("Zwrot płatność  przekazana do księgowości  ", "RETURN"),
    ("Zwrot częściowy płatność przekazana do księgowości", "RETURN"),
    ("Retur - Betaling tilbakeført konto", "RETURN"),
    ("REKLAMAATIO", "COMPLAINT"),
    ("Reclamo", "COMPLAINT"),
    ("Reklamacija", "COMPLAINT"),
    ("Fraud", "FRAUD"),
    ("N/A", "UNKNOWN"),
]

# Precedence when one raw status has several candidates
# (1 wins).  Codes not listed (COMPLETED, UNKNOWN) share the fallback rank.
STATUS_PRIORITY = ["FRAUD", "CANCELLED", "COMPLAINT", "RETURN", "SHIPPED",
                   "READY_TO_SHIP", "PROCESSING", "CONFIRMED", "NEW"]
STATUS_FALLBACK_RANK = 99

# Manual monthly rates (currency units -> EUR) for currencies
# the quote services lack, over 2024-01 .. 2025-12, tagged 'manual_fixed'.
MANUAL_RATES = [("COP", "0.00023"), ("RSD", "0.00855")]
MANUAL_RATE_MONTHS = (dt.date(2024, 1, 1), dt.date(2025, 12, 1))
MANUAL_SOURCE = "manual_fixed"

COUNTRY_SCHEMA = T.StructType([
    T.StructField("country_name", T.StringType(), False),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("currency_code", T.StringType(), False),
])
STATUS_SCHEMA = T.StructType([
    T.StructField("raw_status", T.StringType(), False),
    T.StructField("status_std", T.StringType(), False),
])


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, COUNTRY_SCHEMA)


def status_literals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUS_MAP, STATUS_SCHEMA)

