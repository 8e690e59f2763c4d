"""Text deliverables from small result views: messages to landlords and a plain HTML report."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates
from . import views

# The messages, by language.
MESSAGES = {
    "es": ("Hola, vi su anuncio ", ". ¿Sigue disponible? ¿Podría indicarme el costo de mantenimiento y las condiciones del contrato? Gracias."),
    "en": ("Hello, I saw your listing ", ". Is it still available? Could you tell me the maintenance fee and the contract conditions? Thank you."),
}


def message(language: str) -> Column:
    before, after = MESSAGES[language]
    return F.concat(F.lit(before), views.property_label(), F.lit(" ("), F.coalesce("source_url", F.lit("")), F.lit(")"), F.lit(after))


def contact_messages(ranked: DataFrame, top: int) -> DataFrame:
    """(rank, language, text) for the first rows; write it with ``df.write.text`` after joining its columns."""
    rows = ranked.where((F.col("category") == "PRIMARY") & (F.col("rank_in_category") <= top))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("language"), message(k).alias("text")) for k in MESSAGES])).alias("m")
    return rows.select(F.col("rank_in_category").alias("rank"), each).select("rank", "m.language", "m.text")


def html_table(df: DataFrame, rows: int) -> str:
    """The first rows of a view that is already in order."""
    cell = lambda tag, x: f"<{tag}>{html.escape('' if x is None else str(x))}</{tag}>"
    body = "".join("<tr>" + "".join(cell("td", x) for x in r) + "</tr>" for r in df.limit(rows).collect())
    return "<table><tr>" + "".join(cell("th", name) for name in df.columns) + f"</tr>{body}</table>"


def tiles(ranked: DataFrame) -> DataFrame:
    """(name, value): the figures at the head of a report."""
    of = lambda k, v: F.count(F.when(F.col(k) == v, 1))
    both = (F.col("category") == "PRIMARY") & (F.col("budget_class") == "STRICT_ALL_IN")
    counts = {"listings": F.count("*"), "all-in within budget": F.count(F.when(both, 1)), "primary": of("category", "PRIMARY"), "stretch": of("category", "STRETCH"), "near misses": of("category", "NEAR_MISS")}
    entries = F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in counts.items()])
    return ranked.agg(F.explode(entries).alias("t")).select("t.name", "t.value")


def _svg(body: str, width: int, height: int) -> str:
    return f'<svg viewBox="0 0 {width} {height}" role="img" xmlns="http://www.w3.org/2000/svg">{body}</svg>'


def _scale(low: float, high: float, start: float, end: float):
    span = (high - low) or 1.0
    return lambda v: round(start + (v - low) / span * (end - start), 1)


# The colours of the categories.
COLOURS = {"PRIMARY": "#1b6ca8", "STRETCH": "#c77d0a", "NEAR_MISS": "#888888"}


def dots_svg(df: DataFrame, x: str, y: str, rows: int, width: int = 640, height: int = 360, margin: int = 40) -> str:
    """Points of a view by two of its columns, coloured by category; the first ``rows`` of it that have both."""
    found = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).orderBy("row_id").select(x, y, "category").limit(rows).collect()
    if not found:
        return _svg("", width, height)
    xs, ys = [float(r[0]) for r in found], [float(r[1]) for r in found]
    right, up = _scale(min(xs), max(xs), margin, width - margin), _scale(min(ys), max(ys), height - margin, margin)
    axis = f'<path d="M{margin} {margin}V{height - margin}H{width - margin}" fill="none" stroke="#999"/><text x="{width // 2}" y="{height - 8}">{html.escape(x)}</text><text x="4" y="{margin - 12}">{html.escape(y)}</text>'
    return _svg(axis + "".join(f'<circle cx="{right(a)}" cy="{up(b)}" r="4" fill="{COLOURS.get(r[2], "#888888")}"/>' for a, b, r in zip(xs, ys, found, strict=True)), width, height)


def source_audit(listings: DataFrame, statements: DataFrame) -> DataFrame:
    """One row for each statement of a run (portals.statement): its verdict and how complete its listings are."""
    cover = aggregates.coverage(listings, "source")
    names = [k for k in cover.columns if k != "source"]
    core = sum((F.coalesce(k, F.lit(0.0)) for k in ("url", "rent", "currency", "bedrooms")), F.lit(0.0)) / 4
    verdict = aggregates.source_status(F.col("records"), F.array_join("notes", "; "), F.col("status"), core, F.coalesce("area", F.lit(0.0)))
    told = F.array_join(F.array(*[F.concat(F.lit(f"{k} "), F.rint(F.col(k) * 100).cast("int").cast("string"), F.lit("%")) for k in names]), ", ")
    said = F.when(F.col("records") > 0, told).otherwise("not measured (no records)")
    return statements.join(cover, "source", "left").select("source", verdict.alias("status"), "method", "records", said.alias("completeness"), F.array_join("notes", "; ").alias("limitations"))


def audit_markdown(audit: DataFrame, stamp: str) -> str:
    """The audit as text; it has a row for each source."""
    parts = [f"# Source audit\n\nUpdated: {stamp}\n"]
    for r in audit.orderBy("source").collect():
        parts.append(f"## {r['source']}: {r['status']}\n\n" + "\n".join(f"- **{k}:** {r[k]}" for k in audit.columns if k not in ("source", "status")) + "\n")
    return "\n".join(parts)


def cards_html(picks: DataFrame, rows: int) -> str:
    """The first rows of a view as cards: its property as the heading, the rest as a list of terms."""
    parts = []
    for r in picks.limit(rows).collect():
        terms = "".join(f"<dt>{html.escape(k.replace('_', ' '))}</dt><dd>{html.escape(str(v))}</dd>" for k, v in r.asDict().items() if k != "property" and v is not None)
        parts.append(f"<section><h3>{html.escape(r['property'] or '')}</h3><dl>{terms}</dl></section>")
    return "".join(parts)


def html_report(shown: dict[str, DataFrame], title: str, rows: int = 30, ranked: DataFrame | None = None, audit: DataFrame | None = None, drawn: int = 2000) -> str:
    """``shown``: views.views(). Top lists are collected, and up to ``drawn`` points for the chart and the map."""
    parts = [html_table(tiles(ranked), rows)] if ranked is not None else []
    parts.append(cards_html(shown["client_top_picks"], 5))
    parts += [f"<h2>{html.escape(name.replace('_', ' '))}</h2>{html_table(shown[name], rows)}" for name in ("client_top_picks", "quiet_space", "best_value", "stretch_top", "contact_guide")]
    parts += [f"<h2>Rent and area</h2>{dots_svg(shown['scatter'], 'area_m2', 'rent_usd', drawn)}", f"<h2>Map</h2>{dots_svg(shown['map_points'], 'longitude', 'latitude', drawn)}"]
    if audit is not None:
        parts.append(f"<h2>Sources</h2>{html_table(audit, rows)}")
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{''.join(parts)}</body></html>"
