"""Features stated in listing text, with the phrase that states them. Patterns read folded text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import wordings
from .literals import hinted
from .text import ORDINALS, amount, fold, found, joined, known, let, listed, mapped, number_word, strip_html, true

# Feature -> (patterns that state it, patterns that deny it), in evaluation order.
FEATURES: dict[str, tuple[list[str], list[str]]] = {
    "semi_furnished": ([r"semiamo(b|u)?blad", r"semiamueblad", r"parcialmente amo(b|u)?blad", r"semifurnished", r"partly furnished"], []),
    "furnished": (
        [r"\bamoblad[oa]s?\b", r"\bamueblad[oa]s?\b", r"\bfully furnished\b", r"\bfurnished\b"],
        [r"sin amoblar", r"sin amueblar", r"no (esta |viene )?amoblado", r"no (esta |viene )?amueblado", r"sin muebles", r"\bunfurnished\b", r"no incluye muebles", r"se entrega vacio"],
    ),
    "balcony": ([r"\bbalcon", r"\bbalcony\b"], [r"sin balcon"]),
    "terrace": ([r"\bterraza\b(?! (comun|compartida|del edificio|en azotea del edificio))", r"\bterrace\b"], [r"sin terraza"]),
    "laundry": ([r"lavanderia", r"zona de lavado", r"area de lavado", r"cuarto de lavado", r"patio de lavado", r"lavadora", r"\blaundry\b", r"washer"], [r"sin lavanderia"]),
    "interior_view": ([r"vista (al |hacia el |a )?interior", r"vista interna", r"contra ?frente", r"da al interior", r"hacia el interior", r"no da a la calle", r"interior[- ]facing", r"\binterior view\b"], []),
    "exterior_view": ([r"vista (a la |hacia la )?calle", r"vista exterior", r"vista al (parque|mar|malecon)", r"frente al (parque|mar|malecon)", r"vista a(l)? (la )?avenida", r"\bexterior view\b", r"ocean view", r"park view"], []),
    "avenue_view": ([r"vista a(l)? (la )?av(enida|\.)?\s", r"frente a (la )?av(enida|\.)", r"con vista a av", r"da a (la )?avenida", r"sobre (la )?avenida", r"facing (the )?avenue"], []),
    "acoustic_windows": ([r"ventanas? acustic", r"antirruido", r"anti[\s-]?ruido", r"doble vidrio", r"termopanel", r"insonoriz", r"aislamiento acustico", r"vidrio (doble|laminado)", r"double[- ]glazed", r"soundproof"], []),
    "quiet_claim": ([r"calle tranquila", r"zona tranquila", r"muy tranquil", r"silencios", r"zona residencial", r"ambiente tranquilo", r"\bquiet\b"], []),
    "elevator": ([r"ascensor", r"elevador", r"\belevator\b", r"\blift\b"], [r"sin ascensor", r"no tiene ascensor"]),
    "security_24h": ([r"vigilancia 24", r"seguridad 24", r"porter(o|ia)", r"conserje", r"recepcion 24", r"control de acceso", r"vigilancia", r"24/7 security", r"24h security", r"doorman", r"guardiania", r"agente de seguridad"], []),
    "gym": ([r"gimnasio", r"\bgym\b"], []),
    "pool": ([r"piscina", r"\bpool\b"], []),
    "coworking": ([r"co-?working", r"sala de trabajo", r"business center"], []),
    "common_areas": ([r"zona de parrilla", r"\bparrilla", r"\bbbq\b", r"\bsum\b", r"sala de usos multiples", r"areas? comunes", r"azotea", r"roof ?top", r"terraza comun", r"lounge", r"sala de juegos"], []),
    "pets_allowed": (
        [r"acepta(n)? mascotas", r"pet[\s-]?friendly", r"se aceptan mascotas", r"mascotas permitidas", r"admite mascotas", r"pets allowed"],
        [r"no (se )?(aceptan|acepta|admite|admiten|permite|permiten) mascotas", r"sin mascotas", r"no mascotas", r"no pets", r"mascotas no"],
    ),
    "parking_included": (
        [r"incluye (un |1 )?(estacionamiento|cochera)", r"con (estacionamiento|cochera)", r"(1|un|una|dos|2) (estacionamiento|cochera)s?", r"parking (included|space)"],
        [r"sin (estacionamiento|cochera)", r"no (incluye|tiene) (estacionamiento|cochera)", r"estacionamiento (no incluido|adicional|opcional|se alquila aparte|aparte)"],
    ),
    "study": ([r"(con|y|\+) estudio\b", r"home office", r"sala de estudio", r"ambiente (de|para) estudio", r"\bescritorio\b", r"\bstudy room\b", r"\boffice space\b"], []),
    "walk_in_closet": ([r"walk[\s-]?in", r"vestidor", r"closets? amplio", r"amplios? closets?"], []),
    "internet_included": ([r"internet incluido", r"incluye internet", r"wifi incluido", r"incluye wifi", r"internet included", r"(internet|wifi) y (cable|tv)", r"servicios incluidos"], []),
    "maintenance_included": ([r"mantenimiento incluido", r"incluye (el )?mantenimiento", r"incl(uye|\.)? mant", r"maintenance included"], [r"no incluye (el )?mantenimiento", r"mas mantenimiento", r"\+ ?mantenimiento", r"mantenimiento aparte"]),
    "studio_text": (wordings()["studio_text"], []),
    "short_term": ([r"temporal", r"por dias", r"por semanas", r"airbnb", r"corta estancia", r"short[- ]term"], []),
    "shared": (wordings()["shared"], []),
}

# Number, contract, deposit, floor, fee and utility wordings.
NUMBER = r"(\d{1,2}|un|uno|una|dos|tres|cuatro|seis|doce|dieciocho|veinticuatro)"
CONTRACT = (rf"(?:contrato|plazo|alquiler|arrendamiento)[^.\n]{{0,25}}?(?:minimo|min\.?)?[^.\n]{{0,10}}?{NUMBER}\s*(anos?|mes(?:es)?)\b", rf"minimo (?:de )?{NUMBER}\s*(anos?|mes(?:es)?)\b")
DEPOSIT = (rf"{NUMBER}\s*mes(?:es)?\s*(?:de )?garantia", rf"garantia[:\s]*(?:de )?{NUMBER}\s*mes(?:es)?")
ADVANCE = (rf"{NUMBER}\s*mes(?:es)?\s*(?:de )?adelanto", rf"adelanto[:\s]*(?:de )?{NUMBER}\s*mes(?:es)?")
FLOOR = (r"(?:\b|^)(\d{1,2})\s*(?:°|º|er|do|ro|to|vo|mo|no)?\s*piso\b", r"\bpiso\s*(?:n[°º.]?\s*)?(\d{1,2})\b")
FEE = r"mantenimiento[^\d\n]{0,25}?(s/\.?|us\$|usd|\$|soles|dolares)?\s*([\d][\d.,]*)\s*(soles|dolares|usd|pen)?"
UTILITY = r"(?:agua|luz|gas|internet|wifi|cable|mantenimiento|servicios|arbitrios)"
UTILITIES = rf"incluye[n]?\s+({UTILITY}(?:\s*(?:,|y|e)\s*{UTILITY})*)"
DOLLARS = ("us$", "usd", "$", "dolares")

# Wordings about tenants from abroad, with what they say.
STRONG = {
    "accepts foreigners": r"(acepta(n|mos)?|se aceptan|bienvenid[oa]s?|ideal para|apto para|perfecto para)\s+(a\s+)?extranjer",
    "expat-oriented": r"\bexpats?\b|expatriad",
    "passport mentioned": r"pasaporte|passport",
    "corporate lease possible": r"contrato corporativo|alquiler corporativo|a nombre de (la )?empresa|corporate (lease|rental|housing)",
    "foreigners welcome / English spoken": r"foreigners? (are )?(welcome|accepted)|english (is )?spoken|se habla ingles",
}
SOFT = {
    "temporary / short stays offered": r"alquiler temporal|temporada|corta estancia|estancia corta|por meses|short[- ]term|minimo (1|2|3|6) mes",
    "aimed at executives": r"ejecutiv",
    "no guarantor required": r"sin aval|no (se )?requiere aval|sin garante|sin fiador",
}
FRICTION = {
    "foreigners explicitly not accepted": r"no (se )?(acepta|aceptan|aceptamos) extranjer|solo (peruanos|nacionales)",
    "guarantor (aval/fiador) requested": r"(?<!sin )(?<!no requiere )(?<!no se requiere )\b(aval|fiador|garante)\b",
    "carné de extranjería requested": r"carn[eé]t? de extranjer",
    "Peruvian DNI requested": r"(copia|presentar|requisito[s]?:?)[^.\n]{0,25}\bdni\b",
}
NOTED = {
    "proof of income requested": r"boletas? de pago|constancia de (ingresos|trabajo)|sustento de ingresos|recibos? por honorarios|certificado de trabajo|proof of income|carta de trabajo",
    "utilities included": r"servicios incluidos|incluye (agua|luz|internet|wifi|servicios|gas)",
}
ENGLISH, ENGLISH_WORDS = r"\b(the|with|apartment|bedroom|fully|located|walking distance|available)\b", 6


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def reading_text(*texts: Column) -> Column:
    """The texts stripped, joined and folded, with 'semi' glued to what it qualifies."""
    parts = [F.nullif(strip_html(t), F.lit("")) for t in texts]
    return F.regexp_replace(fold(F.concat_ws(" \n ", *parts)), r"\bsemi[\s-]+(amo|amue|furn)", "semi$1")


def feature(text: Column, name: str) -> Column:
    """False if denied, else true if stated, else null."""
    stated, denied = FEATURES[name]
    says = lambda patterns: hinted(text, patterns) & text.rlike(any_of(patterns))
    value = F.when(says(denied), False) if denied else F.when(F.lit(False), False)
    return value.when(says(stated), True)


def features(text: Column) -> dict[str, Column]:
    out = {name: feature(text, name) for name in FEATURES}
    out["furnished"] = F.coalesce(out["furnished"], F.when(true(out["semi_furnished"]), False))
    return out


def _cited(text: Column, pattern: str, pad: int = 25) -> Column:
    at = F.regexp_instr(text, F.lit(f"({pattern})"))
    start = F.greatest(F.lit(1), at - pad)
    size = F.length(F.regexp_substr(text, F.lit(pattern)))
    return F.when(at > 0, F.concat(F.lit("…"), F.trim(F.substring(text, start, at + size + pad - start)), F.lit("…")))


def evidence(text: Column) -> Column:
    """For each feature found, the phrase around the first pattern of its list that matches."""
    def of(name: str) -> Column:
        stated, denied = FEATURES[name]
        no = [F.when(hinted(text, [p]), F.concat(F.lit(f"{name}=False: "), _cited(text, p))) for p in denied]
        yes = [F.when(hinted(text, [p]), F.concat(F.lit(f"{name}: "), _cited(text, p))) for p in stated]
        return F.when(hinted(text, stated + denied), F.coalesce(*no, *yes))

    return listed(*[of(name) for name in FEATURES])


def _first(text: Column, patterns: tuple[str, ...], group: int) -> Column:
    return F.coalesce(*[found(text, p, group) for p in patterns])


def _months(text: Column, patterns: tuple[str, ...]) -> Column:
    return let(number_word(_first(text, patterns, 1)), lambda n: F.when(n <= 12, n))


def contract_months(text: Column) -> Column:
    unit, n = _first(text, CONTRACT, 2), number_word(_first(text, CONTRACT, 1))
    return let(n, lambda k: F.when(k != 0, F.when(unit.startswith("ano"), k * 12).otherwise(k).cast("int")))


def floor(text: Column) -> Column:
    ordinal = mapped(found(text, r"\b(" + "|".join(ORDINALS) + r")\s+piso\b"), ORDINALS)
    return F.coalesce(_first(text, FLOOR, 1).try_cast("int"), ordinal)


def fee(text: Column) -> tuple[Column, Column, Column]:
    """Maintenance amount, its currency, and whether the currency is assumed; null where maintenance is included."""
    value = amount(found(text, FEE, 2))
    token = F.coalesce(found(text, FEE, 1), found(text, FEE, 3))
    usable = value.between(30, 2500) & ~true(feature(text, "maintenance_included"))
    currency = F.when(token.isin(*DOLLARS), "USD").otherwise("PEN")
    return F.when(usable, value), F.when(usable, currency), F.when(usable, token.isNull())


def utilities(text: Column) -> Column:
    return F.nullif(F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(UTILITIES), F.lit(1)))), "; "), F.lit(""))


def signals(t: Column) -> dict[str, Column]:
    """Everything that a reading text says, by name. Make the text a column first: it is read some two hundred times."""
    value, currency, assumed = fee(t)
    return features(t) | {
        "minimum_contract_months": contract_months(t), "deposit_months": _months(t, DEPOSIT), "advance_months": _months(t, ADVANCE), "floor": floor(t),
        "maintenance_text_amount": value, "maintenance_text_currency": currency, "maintenance_text_currency_assumed": assumed, "utilities_included": utilities(t),
    }


def foreign_text(title: Column, description: Column) -> Column:
    """The text that ``foreign_tenant_in`` reads."""
    return fold(strip_html(joined(" ", title, description)))


def foreign_tenant_in(text: Column, furnished: Column, contract: Column) -> tuple[Column, Column]:
    """(class, evidence): friction first, then strong wording, then soft wording or practical signs.

    Make the text a column first: it is read some fifty times.
    """
    says = {p: hinted(text, [p]) & text.rlike(p) for table in (STRONG, SOFT, FRICTION, NOTED) for p in table.values()}
    any_in = lambda table: reduce(lambda x, y: x | y, [says[p] for p in table.values()])
    labels = lambda table: [F.when(says[p], F.lit(label)) for label, p in table.items()]
    english = F.regexp_count(text, F.lit(ENGLISH)) >= ENGLISH_WORDS
    practical = true(furnished) & says[NOTED["utilities included"]]
    kind = F.when(any_in(FRICTION), "POTENTIAL_FRICTION").when(any_in(STRONG), "HIGH").when(any_in(SOFT) | english | practical, "MEDIUM").otherwise("UNKNOWN")
    noted = [*labels(NOTED), F.when(true(furnished), F.lit("furnished")), F.when(contract.cast("double") != 0, F.concat(F.lit("minimum stay "), contract.cast("int").cast("string"), F.lit(" months")))]
    said = listed(*labels(STRONG), *labels(SOFT), F.when(english, F.lit("listing written in English")), *labels(FRICTION), *noted)
    return F.when(known(text), kind).otherwise("UNKNOWN"), F.when(known(text), F.array_join(F.array_distinct(said), "; ")).otherwise("")


def foreign_tenant(title: Column, description: Column, furnished: Column, contract: Column) -> tuple[Column, Column]:
    """``foreign_tenant_in`` for single texts; over tables, make ``foreign_text`` a column of its own."""
    both = let(foreign_text(title, description), lambda text: F.struct(*[x.alias(k) for k, x in zip(("kind", "said"), foreign_tenant_in(text, furnished, contract), strict=True)]))
    return both.getField("kind"), both.getField("said")
