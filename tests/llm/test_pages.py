"""HTML extraction: thresholds over tag paths decide, whatever the elements are called."""

import math
import re
import time

import pytest

from millrace.llm import html_text
from tests.llm.test_operators import prose

TABLE = "/root/testdata/sf0.1/pages.parquet"


def story(seed, n):
    words = [". ".join(x.capitalize() for x in re.findall(r"(?:\S+ ){7}\S+", prose(seed * 50 + k, 40 + 9 * (k % 5)))) + ", end." for k in range(n)]
    return "".join(f"<p>{w}</p>" for w in words), words


def bare(page):
    """The page without names, and with plain divs for all elements that say what they are."""
    page = re.sub(r"</?(article|header|footer|nav|aside|main|section|form)\b", lambda m: m[0].replace(m[1], "div"), page)
    return re.sub(r'\s(class|id)="[^"]*"', "", page)


NAV = "<div><ul>" + "".join(f'<li><a href="/{k}">Section {k}</a></li>' for k in range(7)) + "</ul></div>"
FOOT = "<div>Copyright 2024 Some House, all rights</div>"


def mixed():
    """(page, its article): bare containers, unnamed comments, a long cookie notice, a story among divs."""
    out = []
    for k in range(12):
        body, words = story(k, 5 + k % 4)
        out.append((f"<body>{NAV}<div><h1>Head {k}</h1>{body}</div>{FOOT}</body>", [f"Head {k}", *words]))
        out.append((f"<body>{NAV}<div>Advert: buy it now</div><div><div><h1>Head {k}</h1></div><div>{body}<ul><li>One, two.</li><li>Three.</li></ul>{body}</div></div>{NAV}{FOOT}</body>", [f"Head {k}", *words, "One, two.", "Three.", *words]))
        short, few = story(k + 40, 2)
        said = "".join(f"<div><b>Reader {j}</b><div>{' '.join(story(60 + j, 1)[1])}</div></div>" for j in range(6))
        out.append((f"<body>{NAV}<article><h1>Head</h1>{short}</article><section>{said}</section>{FOOT}</body>", ["Head", *few]))
        out.append((f"<body><div class='cookie-banner'>{''.join(f'<p>{w}</p>' for w in story(k + 80, 9)[1])}</div>{NAV}<div><h1>Head</h1>{short}</div>{FOOT}</body>", ["Head", *few]))
    return out


def test_pages_without_names():
    for page, words in mixed():
        assert html_text.extract(page).split("\n") == words


def test_thresholds_decide(monkeypatch):
    monkeypatch.setattr(html_text, "content", lambda found: ([True] * len(found), [1.0] * len(found)))
    changed = [html_text.extract(page).split("\n") != words for page, words in mixed()]
    assert sum(changed) > 0.7 * len(changed)


def test_pages_of_the_table_without_names(spark):
    pages = [r["html"] for r in spark.read.parquet(TABLE).limit(150).collect()]
    same = [html_text.extract(bare(p)) == html_text.extract(p) for p in pages]
    assert sum(same) >= 0.97 * len(same)


def test_ratios_smoothing_and_fusion_by_brute_force():
    for page, _ in mixed()[:20]:
        found, _ = html_text.leaves(page)

        def chain(e):
            tags = []
            while e is not None:
                tags.append(e)
                e = e.parent
            return tags[::-1]

        def value(leaves):
            text = sum(len(x.text) - min(x.linked, len(x.text)) for x in leaves) / len(leaves)
            marks = sum(len(html_text.PUNCTUATION.findall(x.text)) for x in leaves) / len(leaves)
            return math.log1p(text * (1 + marks))

        def shared(a, b):
            x, y = chain(a), chain(b)
            same = 0
            while same < min(len(x), len(y)) and (x[same] is y[same] or x[same].path == y[same].path):
                same += 1
            return 1.0 if a.path == b.path else same / max(len(x), len(y))

        ratio = [value([y for y in found if y.path == x.path]) for x in found]
        smooth = []
        for i, x in enumerate(found):
            w = {j: math.exp(-((i - j) ** 2) / 2) * shared(x.element, found[j].element) for j in range(len(found)) if abs(i - j) <= 2}
            smooth.append(sum(w[j] * ratio[j] for j in w) / sum(w.values()))
        mean = sum(smooth) / len(smooth)
        limit = mean - 0.25 * math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth)) - 1e-9
        chosen, scores = html_text.content(found)
        for i, x in enumerate(found):
            path = [smooth[j] for j, y in enumerate(found) if y.path == x.path]
            assert chosen[i] == (sum(path) / len(path) >= limit) or abs(sum(path) / len(path) - limit) < 1e-9
            own = math.log1p((len(x.text) - min(x.linked, len(x.text))) * (1 + len(html_text.PUNCTUATION.findall(x.text)))) if x.linked < len(x.text) else 0.0
            assert abs(scores[i] - ((smooth[i] + own) / 2 - limit)) < 1e-6


@pytest.mark.parametrize("inside", ["-" * 1_000_000, "data" * 250_000, "a " * 500_000, "a=" * 500_000, "a ='" * 250_000, "hidden" * 150_000, "=" * 1_000_000, "a" + " " * 1_000_000])
def test_attributes_take_linear_time(inside):
    began = time.perf_counter()
    html_text.extract(f"<div {inside}>text</div>")
    assert time.perf_counter() - began < 2


def test_empty_pages_with_clashing_columns(spark):
    rows = spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars long")
    assert html_text.extract_pages(rows).count() == 0
