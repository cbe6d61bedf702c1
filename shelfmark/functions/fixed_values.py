"""Values that results depend on, stated once.

Fixed values: patterns, spellings, labels, weights and thresholds below must
equal those of the system whose results this library reproduces.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple


class DateShape(NamedTuple):
    """A date spelling: the shape a text must have and how to read it."""

    shape: str
    pattern: str


# --- text shapes -----------------------------------------------------------
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
DIGITS = r"^[0-9]+$"
UNSIGNED_DECIMAL = r"^[0-9]+(\.[0-9]+)?$"

YMD_DASH = DateShape(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd")
YMD_SLASH = DateShape(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd")
DMY_SLASH = DateShape(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy")
DMY_DASH = DateShape(r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "dd-MM-yyyy")

REGISTRATION_DATES = (YMD_DASH, YMD_SLASH, DMY_SLASH)
BIRTH_DATES = (YMD_DASH, DMY_SLASH)
ORDER_DATES = (YMD_DASH, DMY_SLASH)
REVIEW_DATES = (YMD_DASH, DMY_DASH)

# Text that marks a review date as unusable.
UNUSABLE_REVIEW_DATE = "invalid-date"

# --- canonical spellings: canonical value -> lower-case variants ------------
COUNTRIES = {
    "Brasil": ("brasil", "brazil", "br"),
}
CATEGORIES = {
    "Fantasia": ("fantasia",),
    "Ficção Científica": ("ficção científica",),
    "Ficção": ("ficção", "ficcao", "ficao"),
    "Suspense": ("suspense",),
    "Terror": ("terror",),
    "Romance": ("romance",),
    "Romance Clássico": ("romance clássico",),
    "Literatura Brasileira": ("literatura brasileira",),
}
STATUSES = {
    "Entregue": ("entregue",),
    "Em Trânsito": ("em trânsito", "em transito"),
    "Processando": ("processando",),
    "Cancelado": ("cancelado",),
}
LANGUAGES = {
    "PT-BR": ("pt", "pt-br", "pt_br", "português"),
    "EN": ("en", "english", "inglês"),
}
PAYMENTS = {
    "Cartão de Crédito": ("cartão de crédito", "cartao de credito"),
    "Cartão de Débito": ("cartão de débito", "cartao de debito"),
    "PIX": ("pix",),
    "Boleto": ("boleto",),
    "Cartão": ("cartao",),
}
PAYMENT_WILDCARDS = {
    "Cartão de Crédito": "%cart%credit%",
    "Cartão de Débito": "%cart%deb%",
}
CANCELLED = "Cancelado"
DELIVERED = "Entregue"

# --- limits -----------------------------------------------------------------
OLDEST_PUBLICATION_YEAR = 1000
LARGEST_COUNT = 2_147_483_647
SUBTOTAL_TOLERANCE = Decimal("0.01")

# --- quality weights ----------------------------------------------------------
CUSTOMER_WEIGHT = Decimal("0.20")
BOOK_WEIGHT = Decimal("0.15")
BOOK_ISBN_WEIGHT = Decimal("0.10")
ORDER_WEIGHT = Decimal("0.20")

# --- segmentation -------------------------------------------------------------
RECENCY_BANDS = ((60, "Ativo"), (180, "Em Risco"))
RECENCY_OTHERWISE = "Inativo"
AT_RISK = "Em Risco"
SPEND_TIERS = ((300, "VIP"), (150, "Regular"))
SPEND_OTHERWISE = "Novo"
PREMIUM_RATING = Decimal("4.5")

# --- quality reporting ----------------------------------------------------------
PERFECT_SCORE = Decimal("1.0")
CRITICAL_BELOW = Decimal("0.6")
SCORE_BANDS = (
    (Decimal("1.0"), "1.0 (Perfeito)"),
    (Decimal("0.8"), "0.8–0.9 (Bom)"),
    (Decimal("0.6"), "0.6–0.7 (Regular)"),
)
SCORE_BAND_OTHERWISE = "< 0.6 (Crítico)"
VALID_ORDER_TARGET = Decimal("0.80")
ENTITY_LABELS = {
    "customers": "Clientes",
    "books": "Livros",
    "orders": "Pedidos",
    "items": "Itens de Pedido",
    "reviews": "Avaliações",
}
NO_AMOUNT = "Sem valor"
NO_DATE = "Data inválida"
