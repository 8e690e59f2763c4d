"""Text scalars: Column in, Column out, all inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms, and signs that compatibility decomposition changes.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ²³¹ºª"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy231oa"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&ntilde;", "ñ"), ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&oacute;", "ó"), ("&uacute;", "ú"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
NUMBER_WORDS = {"un": 1, "uno": 1, "una": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12, "dieciocho": 18, "veinticuatro": 24}
ORDINALS = {"primer": 1, "primero": 1, "segundo": 2, "tercer": 3, "tercero": 3, "cuarto": 4, "quinto": 5, "sexto": 6, "septimo": 7, "setimo": 7, "octavo": 8, "noveno": 9, "decimo": 10}


def known(c: Column) -> Column:
    """Neither null nor empty text."""
    return c.isNotNull() & (c.cast("string") != "")


def true(c: Column) -> Column:
    """True, and not unknown: for three-valued flags."""
    return c.eqNullSafe(F.lit(True))


def number(c: Column) -> Column:
    """A double, null where it isn't a number."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value made once, however often the body names it; else each mention would be a copy.

    ``element_at`` knows its type; ``get`` inside a lambda would ask the whole body for it at each row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def mapped(c: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def first_of(*values: Column) -> Column:
    return F.coalesce(*values)


def joined(separator: str, *parts: Column) -> Column:
    """The parts that are known, joined."""
    return F.concat_ws(separator, *[F.nullif(p.cast("string"), F.lit("")) for p in parts])


def listed(*parts: Column) -> Column:
    """An array of the texts that aren't null, in order; none of them is the bare character U+0000.

    ``array_compact`` runs outside generated code, and all parts with it.
    """
    return F.array_remove(F.array(*[F.coalesce(p, F.lit("\0")) for p in parts]), F.lit("\0"))


def unescape(c: Column) -> Column:
    """Common character references; any other stays as it is."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, c)


def strip_html(c: Column) -> Column:
    text = F.regexp_replace(unescape(c), r"(?i)<br\s*/?>|</p>|</li>", "\n")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"[ \t\r\f\x0B]+", " ")
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), r"\p{M}+", "")


def number_word(c: Column) -> Column:
    words = {k: float(v) for k, v in NUMBER_WORDS.items()}
    return let(fold(F.trim(c)), lambda token: F.coalesce(mapped(token, words), F.replace(token, F.lit(","), F.lit(".")).try_cast("double")))


def amount(c: Column) -> Column:
    """'3.500', '3,500', '1.250,50', '950': the last of two kinds of separators is the decimal one; one kind with three digits behind it groups thousands."""
    def read(s: Column) -> Column:
        comma, dot = F.instr(F.reverse(s), ","), F.instr(F.reverse(s), ".")  # places from the end, 0 if none
        no_dots, no_commas = F.replace(s, F.lit("."), F.lit("")), F.replace(s, F.lit(","), F.lit(""))
        pointed = F.replace(s, F.lit(","), F.lit("."))
        value = (
            F.when((comma > 0) & (dot > 0), F.when(comma < dot, F.replace(no_dots, F.lit(","), F.lit("."))).otherwise(no_commas))
            .when(comma > 0, F.when(comma == 4, no_commas).otherwise(pointed))
            .when(dot > 0, F.when(dot == 4, no_dots).otherwise(s))
            .otherwise(s)
        )
        return F.when(s != "", value.try_cast("double"))

    return let(F.regexp_replace(c, r"[^\d.,]", ""), read)


def money_currency(c: Column) -> Column:
    t = fold(c)
    soles = t.rlike(r"s/|\bpen\b|\bsol(es)?\b")
    return F.when(soles, "PEN").when(t.rlike(r"us\$|usd|u\$s|\bdolar|\$") & ~t.rlike("s/"), "USD")


def money_amount(c: Column) -> Column:
    return amount(found(fold(c), r"(\d[\d.,]*)"))


def to_float(c: Column) -> Column:
    """The first number in a text, with its sign."""
    token = F.regexp_extract(c.cast("string"), r"(-?\d[\d.,]*)", 1)
    return let(token, lambda t: F.when(t.startswith("-"), -1.0).otherwise(1.0) * amount(t))


def to_int(c: Column) -> Column:
    return F.bround(to_float(c), 0).try_cast("int")


def to_bool(c: Column) -> Column:
    s = F.lower(F.trim(c.cast("string")))
    return F.when(s.isin("true", "si", "sí", "yes", "1", "y"), True).when(s.isin("false", "no", "0", "n"), False)


def relative_days(c: Column) -> Column:
    """'hace 3 dias' -> 3; today and hours -> 0; yesterday -> 1."""
    t = fold(c)
    pattern = r"hace\s+(mas de\s+)?(\d+|un|una|dos|tres)\s+(dias?|semanas?|mes(?:es)?|anos?)"
    unit = found(t, pattern, 3)
    factor = F.when(unit.startswith("dia"), 1).when(unit.startswith("semana"), 7).when(unit.startswith("mes"), 30).when(unit.isNotNull(), 365)
    days = (F.coalesce(number_word(found(t, pattern, 2)), F.lit(0.0)) * factor).cast("int")
    return F.when(t.rlike(r"\bhoy\b|hace (\d+ )?(minutos?|horas?)"), 0).when(t.contains("ayer"), 1).otherwise(days)


def date_text(c: Column, scraped: Column) -> Column:
    """ISO date of an epoch, an ISO or day-first date, or relative text; epochs are read in the session's zone."""
    return let(c, lambda v: _date_text(v, scraped))


def _date_text(c: Column, scraped: Column) -> Column:
    n = F.when(c.rlike(r"^\d+(\.\d+)?$"), c.try_cast("double"))
    seconds = F.when(n > 1e9, F.when(n > 1e11, n / 1000).otherwise(n))
    d, m, y = (F.regexp_extract(c, r"(\d{1,2})/(\d{1,2})/(\d{4})", k) for k in (1, 2, 3))
    return F.coalesce(
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"),
        found(c, r"(\d{4}-\d{2}-\d{2})"),
        F.when(c.rlike(r"\d{1,2}/\d{1,2}/\d{4}"), F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"))),
        F.date_format(F.date_sub(F.to_date(F.left(scraped, F.lit(10))), relative_days(c)), "yyyy-MM-dd"),
    )


def norm_url(c: Column) -> Column:
    """Host without www. and path without its last slash, lower case; query and fragment go."""
    rest = F.regexp_replace(c, r"[?#].*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", ""), r"/+$", "")
    return F.when(known(c), F.lower(F.concat(host, path)))


def norm_address(c: Column) -> Column:
    a = F.regexp_replace(fold(F.coalesce(c, F.lit(""))), r"\b(avenida|av\.?)\b", "av")
    a = F.regexp_replace(a, r"\b(calle|jr\.?|jiron|psje\.?|pasaje)\b", "")
    return F.trim(F.regexp_replace(F.regexp_replace(a, r"miraflores|lima|peru|\bmir\b", ""), "[^a-z0-9 ]", " "))


def street_numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b(\d{2,5})\b"), F.lit(1)))


def phone(c: Column) -> Column:
    d = F.regexp_replace(c.cast("string"), r"\D", "")
    d = F.when(d.startswith("00"), F.substring(d, 3, 100)).otherwise(d)
    full = (
        F.when((F.length(d) == 9) & d.startswith("9"), F.concat(F.lit("51"), d))
        .when(F.length(d).isin(7, 8) & ~d.startswith("51"), F.concat(F.lit("511"), F.right(d, F.lit(7))))
        .otherwise(d)
    )
    return F.when(F.regexp_replace(c.cast("string"), r"\D", "") != "", F.concat(F.lit("+"), full))


def mobile(c: Column) -> Column:
    d = F.regexp_replace(c, r"\D", "")
    return F.when(d.startswith("519") & (F.length(d) == 11), d)


def quoted(c: Column) -> Column:
    """Percent-encoding that keeps slashes and writes spaces as %20."""
    return F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def chat_link(c: Column, message: Column | None = None) -> Column:
    link = F.concat(F.lit("https://wa.me/"), mobile(c))
    return link if message is None else F.concat(link, F.lit("?text="), quoted(message))


def map_link(lat: Column, lon: Column, address: Column, city: str) -> Column:
    base = F.lit("https://www.google.com/maps/search/?api=1&query=")
    point = F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("%.6f,%.6f", lat, lon))
    return F.concat(base, F.coalesce(point, F.when(known(address), quoted(F.concat(address, F.lit(city))))))


def geocodable(c: Column) -> Column:
    return fold(c).rlike(r"[a-z]{3,}.*\d{2,4}")


def scrubbed(c: Column) -> Column:
    """Access tokens masked."""
    return F.regexp_replace(c, r"(?i)(token=|bearer\s+)[A-Za-z0-9_.-]+", "$1***")


def shortened(c: Column, limit: int) -> Column:
    """At most ``limit`` characters, cut at a word's end."""
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.regexp_replace(F.substring(c, 1, limit), r"\s\S*$", ""), F.lit("…")))


def whole(c: Column) -> Column:
    """A number without decimals and with thousands separators, halves to even."""
    return F.format_number(F.rint(c), 0)


def plain(c: Column) -> Column:
    return F.format_string("%d", F.rint(c).cast("long"))
