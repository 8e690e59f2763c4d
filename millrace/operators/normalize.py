"""From mapped records to consistent listings: text fills what is unknown, then district, phone and money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import signals as S
from ..functions import text as T
from ..functions.money import with_currencies
from ..schema import conform

# Fields that text may fill, those it fills under another name, and neighbouring districts.
FILLED = (
    "furnished semi_furnished balcony terrace laundry interior_view exterior_view acoustic_windows elevator security_24h gym pool coworking common_areas"
    " pets_allowed study walk_in_closet avenue_view quiet_claim internet_included minimum_contract_months deposit_months advance_months floor utilities_included"
).split()
RENAMED = {"studio_text": "studio_text", "short_term": "short_term_text", "shared": "shared_room_text"}
DISTRICTS = ("san isidro", "surquillo", "barranco", "santiago de surco", "surco", "san borja", "lince", "jesus maria", "magdalena", "san miguel", "chorrillos", "la victoria", "lima cercado")


def district(cfg: Config) -> tuple[Column, Column]:
    """(district, note): the stated field first, then address and title; the note tells when the title disagrees."""
    c = F.col
    field, blob = T.fold(T.joined(" | ", c("district"), c("subarea"))), T.fold(T.joined(" | ", c("address"), c("title")))
    target = T.fold(F.lit(cfg.district))
    excluded = lambda where: [F.when(where.contains(x), F.lit(x.title())) for x in cfg.excluded_districts]
    other = F.coalesce(*[F.when(field.contains(x), F.lit(x.title())) for x in DISTRICTS])
    stated = F.coalesce(*excluded(field), F.when(field.contains(target), F.lit(cfg.district)), other)
    value = F.coalesce(F.when(field != "", F.coalesce(stated, F.nullif(c("district"), F.lit("")))), *excluded(blob), F.when(blob.contains(target), F.lit(cfg.district)), c("district"))
    clash = (field != "") & F.coalesce(*excluded(field), F.when(field.contains(target), F.lit(""))).isNull() & other.isNotNull() & T.fold(F.coalesce(c("title"), F.lit(""))).contains(target)
    note = F.when(clash, F.concat(F.lit(f"title mentions {cfg.district} but district field says '"), F.coalesce(c("district"), F.lit("None")), F.lit("'")))
    return value, note


def normalize(df: DataFrame, cfg: Config, rate: float | Column) -> DataFrame:
    """Listing columns of any subset -> complete listings."""
    c = F.col
    base = conform(df)
    sig = S.signals(c("__text"))
    read = base.withColumn("__text", S.reading_text(c("title"), c("description"), F.array_join("amenities", " ; ")))
    said = read.withColumns({f"__{k}": v for k, v in sig.items()} | {"__evidence": S.evidence(c("__text"))})
    fill = {k: F.coalesce(c(k), c(f"__{k}").cast(base.schema[k].dataType)) for k in FILLED}
    fill |= {to: F.coalesce(c(to), c(f"__{src}")) for src, to in RENAMED.items()}
    fill["parking_included"] = F.coalesce(c("parking_included"), c("parking_spaces") > 0, c("__parking_included"))
    # Maintenance: what the source states, then "included" in the text, then an amount in the text.
    silent = c("maintenance_fee").isNull() & c("maintenance_included_in_rent").isNull()
    free = silent & T.true(c("__maintenance_included"))
    quoted = silent & ~free & c("__maintenance_text_amount").isNotNull()
    fill["maintenance_included_in_rent"] = F.when(free, True).otherwise(c("maintenance_included_in_rent"))
    fill["maintenance_fee"] = F.when(quoted, c("__maintenance_text_amount")).otherwise(c("maintenance_fee"))
    fill["maintenance_currency"] = F.when(quoted, c("__maintenance_text_currency")).otherwise(c("maintenance_currency"))
    assumed = F.when(T.true(c("__maintenance_text_currency_assumed")), F.lit(" (currency not stated — assumed PEN)")).otherwise("")
    note = F.when(quoted, F.concat(F.lit("maintenance amount read from description"), assumed))
    where, clash = district(cfg)
    fill["text_signals"] = F.array_distinct(F.concat("text_signals", c("__evidence"), T.listed(note, clash)))
    fill["raw_description"] = F.coalesce("raw_description", "description")
    fill["bedrooms"] = F.coalesce(c("bedrooms"), T.found(c("title"), r"(?i)(\d)\s*(?:dormitorio|dorm\.?|habitaci[oó]n|hab\.?|bedroom)").cast("int"))
    fill["district"] = where
    fill["phone"], fill["whatsapp"] = (F.when(T.known(c(k)), T.phone(c(k))).otherwise(c(k)) for k in ("phone", "whatsapp"))
    out = said.withColumns(fill).drop(*[f"__{k}" for k in sig], "__evidence", "__text")
    return with_currencies(out, rate)
