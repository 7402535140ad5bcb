"""Main text by maximum-scoring subsequences (operator 4).

A page is a sequence of tokens: words, each under the element it stands in, and
tags.  Weights are log-odds of a token kind inside against outside the content,
learned from labelled pages (those that mark their content with <article>), on
top of a prior in which words are positive and tags are negative.  One linear
scan finds the contiguous region with the greatest sum; inside it, words under
elements of negative weight (adverts, forms, reader comments) are left out.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from featurejudge.llm.common import cut_lineage

#: Fixed values of HTML: elements without content, whose content is no markup, and that part blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "noembed", "title", "xmp")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr img".split())
#: Elements that hold no main text; the prior gives them negative weight.
BOILERPLATE = frozenset("head title nav header footer aside form button select option input textarea label fieldset menu dialog "
                        "script style noscript template iframe svg math object noembed xmp".split())
#: Parts of class, id and role words that name boilerplate wherever they stand ...
BOILERPLATE_CLASS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adv|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|overlay|sidebar|aside|widget|"
    r"menu|nav\w*|breadcrumbs?|pager|pagination|toolbar|header|footer|masthead|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscribe|signup|login|comments?|commentlist|replies|reply|respond|disqus|discussion|copyright)(?:$|[\s_-])", re.I)
#: ... and words that name it only if they stand alone ("long-form" is no form).
BOILERPLATE_WORDS = frozenset("form search alert follow legal".split())

PRIOR_WORD, PRIOR_TAG, PRIOR_BOILERPLATE = 1.0, -0.25, -4.0
MOST_COST = -1.0          # of one boilerplate text, however long: an advert does not cut an article in two
PRIOR_COUNT = 20.0        # tokens that the prior counts as
MIN_WORD = 0.05           # what a word outside boilerplate is worth at least
MAX_KINDS = 20_000        # token kinds kept by the model, the most frequent first (others have their prior's weight)
KIND_CHARS = 120          # longest name of a kind

_RAW = "|".join(RAW)
TOKEN = re.compile(
    r"(?P<comment><!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z))"
    rf"|(?P<raw><(?P<rawname>{_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?P<rawtext>.*?)(?:</(?P=rawname)\s*>|\Z))"
    r"|(?P<tag></?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>)"
    r"|(?P<broken></?[a-zA-Z][^>]*(?:>|\Z))"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Elements that an opening block closes, as a browser does.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                    "ol pre section table ul".split())


def kind_of(name: str, attrs: str) -> str:
    """Element name and all its class, id and role words in lower case.  Long
    ones are shortened: to the word that names boilerplate, if any, and a hash."""
    found = [next(filter(None, m), "") for m in ATTRIBUTE.findall(attrs)] if attrs else []
    words = sorted(set(" ".join(found).lower().split()))
    kind = name + "".join("." + w for w in words)
    if len(kind) <= KIND_CHARS:
        return kind
    bad = next((m[0].strip("_- ") for m in map(BOILERPLATE_CLASS.search, words) if m), None) or next(
        (w for w in words if w in BOILERPLATE_WORDS), None)
    return f"{name[:KIND_CHARS]}.#{hashlib.md5(kind.encode('utf-8', 'surrogatepass')).hexdigest()}" + (f".{bad}" if bad else "")


@lru_cache(maxsize=4_096)
def prior(kind: str) -> float:
    """Weight of a word under an element of this kind, before learning."""
    name, *words = kind.split(".")
    if name in BOILERPLATE or any(w in BOILERPLATE_WORDS or BOILERPLATE_CLASS.search(w) for w in words):
        return PRIOR_BOILERPLATE
    return PRIOR_WORD


def tokens(page: str) -> Iterator[tuple[str, str, object]]:
    """("open"|"close"|"text", kind, value) in page order.  ``kind`` of a text
    is that of the element that decides on it: the innermost open element that
    is boilerplate by the prior, else the innermost block.  Comments and raw
    elements (scripts, styles) give nothing; malformed tags are skipped.  A
    token costs constant time (amortised), however many elements are open."""
    # name, kind, and the innermost boilerplate and block up to here
    stack: list[tuple[str, str, str | None, str | None]] = []
    places: dict[str, list[int]] = defaultdict(list)    # of a name's open elements in the stack

    def pop():
        places[stack.pop()[0]].pop()
    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            _, _, bad, block = stack[-1] if stack else ("", "", None, None)
            yield "text", bad or block or "body", m["text"]
        elif m["tag"] is not None:
            name = m["name"].lower()
            if m["tag"].startswith("</"):
                if places[name]:
                    at = places[name][-1]
                    kind = stack[at][1]
                    while len(stack) > at:
                        pop()
                    yield "close", kind, name
                elif name in ("p", "br"):
                    yield "open", name, name
                continue
            kind = kind_of(name, m["attrs"])
            if name not in INLINE:
                shut = _CLOSES.get(name, ()) if name not in _ENDS_P else ("p",)
                while stack and (stack[-1][0] in shut or stack[-1][0] in INLINE and any(places[s] for s in shut)):
                    pop()
            yield "open", kind, name
            if name not in VOID and not m["attrs"].rstrip().endswith("/"):
                _, _, bad, block = stack[-1] if stack else ("", "", None, None)
                places[name].append(len(stack))
                stack.append((name, kind, kind if prior(kind) < 0 else bad, block if name in INLINE else kind))


def scored(page: str, weight: dict[str, float]) -> list[tuple[float, str, str]]:
    """(score, kind, text) a token; for a tag ``text`` is empty and ``kind``
    tells whether it parts blocks."""
    out = []
    for what, kind, value in tokens(page):
        if what == "text":
            n = len(html.unescape(value).split())
            w = weight.get("w " + kind, prior(kind))
            out.append((n * max(w, MIN_WORD) if w > 0 else max(n * w, MOST_COST), "w " + kind, value))
        else:
            out.append((weight.get(f"{what} {kind}", PRIOR_TAG),
                        "inline" if value in INLINE else "block", ""))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the greatest sum (the first and
    shortest one on ties; empty if no sum is positive)."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, region = total, (start, k + 1)
    return region


def extract(page: str | None, weight: dict[str, float]) -> str:
    """Main text: blocks joined by one newline, white space inside a block by one space."""
    if not page:
        return ""
    found = scored(page, weight)
    start, end = best_region([s for s, _, _ in found])
    blocks, parts = [], []
    for score, kind, text in found[start:end]:
        if kind == "block":
            blocks.append("".join(parts))
            parts = []
        elif text and weight.get(kind, prior(kind[2:])) > 0:
            parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def label(page: str) -> list[tuple[str, int]] | None:
    """(token kind, 1 inside or 0 outside the content) of a labelled page: one
    with an <article> element; None for others.  The article's own tags count
    as inside, elements of comments inside an article as outside."""
    out, depth, seen = [], 0, False
    for what, kind, value in tokens(page):
        if what == "open" and value == "article":
            depth, seen = depth + 1, True
        inside = int(depth > 0 and not (prior(kind) < 0 and what != "open"))
        if what == "text":
            out.extend([("w " + kind, inside)] * len(value.split()))
        else:
            out.append((f"{what} {kind}", inside))
        if what == "close" and value == "article":
            depth -= 1
    return out if seen else None


def fit(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Token kind -> weight, counted over all labelled pages (none: the prior
    alone).  A kind's weight is its smoothed log-odds, shrunk to the prior; words
    that the prior calls boilerplate never become positive."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for pdf in batches:
            for page in pdf["html"]:
                n.update(label(page) or ())
            if len(n) > MAX_KINDS:
                yield pd.DataFrame([(k, i, c) for (k, i), c in n.items()], columns=["kind", "inside", "n"])
                n.clear()
        yield pd.DataFrame([(k, i, c) for (k, i), c in n.items()], columns=["kind", "inside", "n"])

    rows = pages.where(F.col(html_col).contains("<article") | F.col(html_col).contains("<ARTICLE")).select(F.col(html_col).alias("html"))
    kinds = cut_lineage(rows.mapInPandas(count, "kind string, inside int, n long").groupBy("kind")
                        .agg(F.sum(F.when(F.col("inside") == 1, F.col("n")).otherwise(0)).alias("inner"), F.sum("n").alias("n")))
    # weights do not depend on how many kinds are kept
    total = kinds.agg(F.coalesce(F.sum("inner"), F.lit(0)).alias("inner"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    inner, outer = total["inner"] + 1, total["n"] - total["inner"] + 1
    got = kinds.orderBy(F.desc("n"), "kind").limit(MAX_KINDS).collect()
    out = {}
    for r in got:
        what, _, kind = r["kind"].partition(" ")
        base = prior(kind) if what == "w" else PRIOR_TAG
        odds = math.log((r["inner"] + 0.5) / inner) - math.log((r["n"] - r["inner"] + 0.5) / outer)
        learned = (r["n"] * max(min(odds, 6.0), -6.0) + PRIOR_COUNT * base) / (r["n"] + PRIOR_COUNT)
        # tags inside the content are a cost as well, so that a region ends with its last word
        out[r["kind"]] = learned if what == "w" and base > 0 else min(learned, base if what == "w" else -0.01)
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row a row of ``pages``.  Null and
    empty html, and pages without a positive region, give an empty text; of
    regions with equal sums the first counts; pages of any length are read
    whole; null ids and urls and repeated rows are kept, an empty table gives
    an empty one; other columns are ignored."""
    spark = pages.sparkSession
    weight = spark.sparkContext.broadcast(fit(pages, html_col))       # at most MAX_KINDS entries

    @pandas_udf("string")
    def article(batch: pd.Series) -> pd.Series:
        return pd.Series([extract(p, weight.value) for p in batch], dtype="object")
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), article(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
