"""Money with its provenance: published figures stay, the other currency is calculated, totals need both parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Config
from .text import known, let, true, whole

# How sources write the two currencies, soles tested first.
SOLES = ("pen", "s/", "s/.", "sol", "soles", "nuevos soles")
DOLLARS = ("usd", "us$", "u$s", "$", "dolar", "dólar", "dolares", "dólares", "us")
CODES = {"2": "USD", "6": "PEN"}


def currency_code(c: Column) -> Column:
    return let(F.lower(F.trim(c)), _currency_code)


def _currency_code(s: Column) -> Column:
    starts = lambda tokens: F.exists(F.array(*map(F.lit, tokens)), lambda t: s.startswith(t))
    coded = [F.when(s == code, name) for code, name in CODES.items()]
    return F.coalesce(*coded, F.when(starts(SOLES), "PEN"), F.when(starts(DOLLARS), "USD"))


def converted(value: Column, currency: Column, rate: Column) -> tuple[Column, Column]:
    """(soles, dollars) of an amount, to cents."""
    known_ = currency.isin("USD", "PEN")
    soles = F.when(known_, F.when(currency == "USD", F.round(value * rate, 2)).otherwise(value))
    dollars = F.when(known_, F.when(currency == "USD", value).otherwise(F.round(value / rate, 2)))
    return soles, dollars


def with_currencies(df, rate: float | Column):
    """Rent, maintenance and totals of a listing table in both currencies, with bases."""
    c, r = F.col, F.lit(rate) if not isinstance(rate, Column) else rate
    priced = c("rent_original").isNotNull() & c("rent_currency").isin("USD", "PEN")
    pen, usd = converted(c("rent_original"), c("rent_currency"), r)
    in_usd = c("rent_currency") == "USD"
    own_pen = c("rent_pen").isNotNull() & F.equal_null(c("rent_pen_basis"), F.lit("PUBLISHED"))
    own_usd = c("rent_usd").isNotNull() & F.equal_null(c("rent_usd_basis"), F.lit("PUBLISHED"))
    side = lambda is_own, own, value, basis, other: F.when(~priced, other).when(is_own, value).when(own, other).otherwise(basis)
    rent = {
        "rent_pen": side(~in_usd, own_pen, c("rent_original"), pen, c("rent_pen")), "rent_pen_basis": side(~in_usd, own_pen, F.lit("PUBLISHED"), F.lit("CALCULATED"), c("rent_pen_basis")),
        "rent_usd": side(in_usd, own_usd, c("rent_original"), usd, c("rent_usd")), "rent_usd_basis": side(in_usd, own_usd, F.lit("PUBLISHED"), F.lit("CALCULATED"), c("rent_usd_basis")),
    }
    free = true(c("maintenance_included_in_rent"))
    charged = ~free & c("maintenance_fee").isNotNull() & c("maintenance_currency").isin("USD", "PEN")
    m_pen, m_usd = converted(c("maintenance_fee"), c("maintenance_currency"), r)
    basis = lambda own: F.when(free, "PUBLISHED").when(charged, F.when(c("maintenance_currency") == own, "PUBLISHED").otherwise("CALCULATED"))
    upkeep = {
        "maintenance_pen": F.when(free, F.lit(0.0)).when(charged, m_pen).otherwise(c("maintenance_pen")), "maintenance_usd": F.when(free, F.lit(0.0)).when(charged, m_usd).otherwise(c("maintenance_usd")),
        "maintenance_pen_basis": F.coalesce(basis("PEN"), c("maintenance_pen_basis")), "maintenance_usd_basis": F.coalesce(basis("USD"), c("maintenance_usd_basis")),
    }
    out = df.withColumns(rent | upkeep | {"fx_rate_usd_pen": r.cast("double")})
    return with_totals(out)


def with_totals(df):
    total = lambda k: F.coalesce(F.round(F.col(f"rent_{k}") + F.col(f"maintenance_{k}"), 2), F.col(f"estimated_total_monthly_{k}"))
    return df.withColumns({f"estimated_total_monthly_{k}": total(k) for k in ("usd", "pen")})


def budget_class(cfg: Config) -> tuple[Column, Column]:
    """Class and note of what a listing costs against the target."""
    rent = F.col("rent_usd")
    total = F.when(true(F.col("maintenance_included_in_rent")), rent).otherwise(F.col("estimated_total_monthly_usd"))
    cheap, usd = rent <= cfg.target_max_rent, lambda c: F.concat(F.lit("USD "), whole(c))
    kind = F.when(rent.isNull(), "UNKNOWN").when(cheap & (total <= cfg.target_max_total), "STRICT_ALL_IN").when(cheap, "BASE_RENT_COMPLIANT").when(rent <= cfg.stretch_max_rent, "STRETCH").otherwise("OVER_BUDGET")
    note = (
        F.when(rent.isNull(), "rent unknown")
        .when(cheap & (total <= cfg.target_max_total), F.concat(F.lit("all-in ≈ "), usd(total)))
        .when(cheap & total.isNotNull(), F.concat(F.lit("rent within budget but total ≈ "), usd(total), F.lit(f" (over USD {cfg.target_max_rent:,.0f})")))
        .when(cheap, "rent within budget; maintenance not published — total unknown")
        .when(rent <= cfg.stretch_max_rent, F.concat(F.lit("rent "), usd(rent), F.lit(" (stretch)")))
        .otherwise(F.concat(F.lit("rent "), usd(rent)))
    )
    return kind, note


def total_text() -> Column:
    c, usd = F.col, lambda x: F.concat(F.lit("USD "), whole(x))
    head = F.concat(F.lit("≈ "), usd(c("estimated_total_monthly_usd")), F.lit(" ("), usd(c("rent_usd")), F.lit(" rent + "))
    soles = (c("maintenance_currency") == "PEN") & c("maintenance_pen").isNotNull()
    return (
        F.when(c("rent_usd").isNull(), "UNKNOWN")
        .when(true(c("maintenance_included_in_rent")), F.concat(usd(c("rent_usd")), F.lit(" (maintenance included in rent)")))
        .when(c("estimated_total_monthly_usd").isNotNull() & soles, F.concat(head, F.lit("S/ "), whole(c("maintenance_pen")), F.lit(" maintenance)")))
        .when(c("estimated_total_monthly_usd").isNotNull(), F.concat(head, F.coalesce(usd(c("maintenance_usd")), F.lit("UNKNOWN")), F.lit(" maintenance)")))
        .otherwise(F.concat(usd(c("rent_usd")), F.lit(" rent + maintenance UNKNOWN")))
    )


def cost_estimate(model: Column, unit: Column, start: Column, per_item: Column, items: int) -> Column:
    """Cost of a collection run by its pricing model; null where the model gives no price for items."""
    return F.when(model == "PRICE_PER_DATASET_ITEM", F.coalesce(unit, F.lit(0.0)) * items).when((model == "PAY_PER_EVENT") & per_item.isNotNull(), F.coalesce(start, F.lit(0.0)) + per_item * items).when(model == "FREE", F.lit(0.0))


def latest_rate(series, fallback: float):
    """One row (usd_pen, live) from (period, value) text: the newest numeric value, or the fallback."""
    value = F.col("value").try_cast("double")
    newest = F.max_by(value, F.when(value.isNotNull(), F.col("period")))
    return series.agg(newest.alias("v")).select(F.coalesce("v", F.lit(fallback)).alias("usd_pen"), F.col("v").isNotNull().alias("live"))


__all__ = ["budget_class", "converted", "cost_estimate", "currency_code", "known", "latest_rate", "total_text", "with_currencies", "with_totals"]
