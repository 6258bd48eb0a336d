"""Main text of web pages by equivalence-class template deduction.

Every page is cut into blocks, each with the path of block elements around it.  A block of text at
a path is a token; so are the path itself and the start of the page.  A token's occurrence vector is its count on each
page of a host; copies of a page count as one page.  Tokens of a host with equal vectors form an equivalence class (vectors
are compared by a commutative hash, so no page list is ever gathered).  A class is valid as template if it occurs on most of the
host's pages, has two tokens or more, and its texts stand in one order on all pages and nest: an
instance of one class lies within one gap of another.  Of two classes that cross, the one of fewer
texts is not valid.  Nor is a class that holds more than half of what its pages would give without a template, and 100 characters a page: that is an
article which stands under several addresses of the host, not the frame around articles that differ.  The texts of valid classes are the fixed text of the site, also inside the article.  Blocks
that are left are the slots.  A slot whose path runs through a menu, header, footer, sidebar,
notice, advert, form or comment section is not main text, whatever it holds, so such blocks take no part
in the classes either.  Class and id words mark block elements alone, not the page itself nor words inside a line; a marked
element or form that holds the article, or nearly all text of a page, is not such a part.  Where a page names its article,
only slots inside it count, its own header among them; elsewhere all remaining slots do.

Defined cases: pages of any length are read whole; blocks of equal text are told apart by path, ties of classes go to the lesser number; null and empty html give an empty text; a null url groups under the empty host; a
page alone on its host has no template and keeps the slots its paths allow; broken markup
is read to the end of the page, a tag whose quotes do not close ends at its first >; repeated rows are separate pages with equal results; an empty table gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Stages

#: The templates of all hosts are broadcast up to so many tokens of eight bytes; more of them shuffle.
BROADCAST_TOKENS = 2_000_000
#: Elements that break a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody tfoot thead title tr ul".split()
)
#: Elements whose text is never main text, and those that hold the article.
DROPPED = frozenset("aside button dialog footer form head header menu nav search select title".split())
MAIN = frozenset("article main".split())
#: Elements inside a line, which class words never mark, and the page itself.
UNMARKED = frozenset("html body a abbr b bdi bdo cite code data dfn em font i kbd label mark math q s samp small span strong sub sup time u var".split())
#: A marked part with this share of a page's text is its content.
MOST = 0.9
#: A class with more than this share of the text of its pages, and at least so many characters a page, is an article with copies.
HALF, ARTICLE = 0.5, 100
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words of class and id names that mark the same kinds of parts.
MARKED = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|sponsor\w*|promo|promotions?|banner|nav\w*|menu|sidebar|side|header|masthead|footer|foot|cookies?|notices?|consent|gdpr|"
    r"newsletter|subscribe|subscription|comments?|replies|discussion|disqus|share|sharing|social(?=$|\s|[-_](?:media|links?|icons?|bar|share|sharing|buttons?|follow))|related|recommended|breadcrumbs?|widgets?|popup|modal|login|signup|search)(?:$|[-_\s])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: SQL: a slot ``b`` that is main text as far as paths tell.
MAIN_TEXT = "(b.inside or not exists(blocks, x -> x.inside and not x.dropped))"
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|noscript|svg|iframe|template|object|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<shut>/?)(?P<open>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _kind(name: str, attributes: str) -> tuple[str, int]:
    """(path step, 1 for parts that are dropped, 2 for the article, 3 for parts dropped by their words or as a form, else 0)."""
    step, flag = name, 3 if name == "form" else 1 if name in DROPPED else 2 if name in MAIN else 0
    if "=" in attributes:
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            value = (a or b or c).strip()
            step += f".{value}"
            if name in UNMARKED:
                continue
            if flag in (0, 3) and key.lower() == "role" and value.lower() in ("main", "article"):
                flag = 2
            elif flag == 0 and (MARKED.search(value) or key.lower() == "role" and value.lower() in ROLES):
                flag = 3
    return step, flag


def blocks_of(page: str | None) -> list[tuple[str, str, bool, bool]]:
    """(path, text, dropped part, inside the article) of every block with text, in page order."""
    page = page or ""
    out: list[tuple[str, str, list[int], list[int], bool]] = []
    stack: list[tuple[str, str, int, int]] = []
    held: list[str] = []
    holds: set[int] = set()  # marked elements around the first article
    named = False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            inside = any(f == 2 for _, _, f, _ in stack)
            first = next((i for i, s in enumerate(stack) if s[2] == 2), len(stack))
            fixed = any(f == 1 and not (name == "header" and i > first) for i, (name, _, f, _) in enumerate(stack))
            out.append((">".join(s for _, s, _, _ in stack), text, fixed, [k for _, _, f, k in stack if f == 3], inside))

    at = 0
    for m in TAG.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        closing, name, attributes = m.group(2, 3, 4) if m.group(3) else m.group("shut", "open", "rest")
        if name is None:
            continue
        name, attributes = name.lower(), attributes or ""
        if name in ("br", "td", "th", "img", "input"):
            held.append(" ")
        marked = "=" in attributes and name not in VOID and name not in UNMARKED and _kind(name, attributes)[1]
        if name in VOID and name != "hr":
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS or depth is not None:
                flush()
            if depth is not None:
                del stack[depth:]
        elif name in BLOCKS or marked:
            flush()
            if stack and stack[-1][0] == "p" and name in BLOCKS:
                stack.pop()
            if stack and stack[-1][0] == name and name in ("li", "tr", "option", "dt", "dd"):
                stack.pop()
            if name == "body":
                del stack[next((i for i, s in enumerate(stack) if s[0] == "head"), len(stack)) :]
            if name != "hr":
                step, flag = _kind(name, attributes)
                if flag == 2 and not named:
                    named = True  # further articles may be comments
                    holds = {k for _, _, f, k in stack if f == 3}
                stack.append((name, step, flag, m.start()))
    held.append(page[at:])
    flush()
    size, total = defaultdict(int), 0
    for _, text, fixed, marks, _ in out:
        if not fixed:
            total += len(text)
            for k in marks:
                size[k] += len(text)
    content = holds | {k for k, n in size.items() if n >= MOST * total}
    return [(path, text, fixed or any(k not in content for k in marks), inside) for path, text, fixed, marks, inside in out]


def evidence(tokens: list[int], classes: list[list[int]]) -> list[tuple[int, int | None, bool]]:
    """(class number, hash of its order or None, crosses a class of more texts) of the classes on a page.

    The texts of a class are in order if they repeat one sequence that holds each of them once.
    """
    own = {t: c for c, group in enumerate(classes) for t in group}
    seen = [t for t in tokens if t in own]
    places = defaultdict(list)
    for t in seen:
        places[own[t]].append(t)
    order: dict[int, int | None] = {}
    for c, ts in places.items():
        m = len(classes[c])
        order[c] = hash(tuple(ts[:m])) if len(set(ts[:m])) == m and ts == ts[:m] * (len(ts) // m) else None
    crossed: set[int] = set()
    at: dict[int, int] = defaultdict(int)
    unfinished: list[int] = []
    for t in seen:
        c = own[t]
        if order[c] is None or len(classes[c]) == 1:
            continue
        if at[c] == 0:
            unfinished.append(c)
        elif c in unfinished:
            while unfinished[-1] != c:
                crossed.add(min(unfinished.pop(), c, key=lambda x: (len(classes[x]), x)))
        at[c] = (at[c] + 1) % len(classes[c])
        if at[c] == 0 and c in unfinished:
            unfinished.remove(c)
    return [(c, order[c], c in crossed) for c in order]


def main_text(pages: DataFrame, stages: Stages, page_id="page_id", url="url", html="html", support: float = 0.5, least: int = 3) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "page_id": pdf["page_id"], "url": pdf["url"],
                "blocks": [[{"path": p, "text": t, "dropped": d, "inside": i} for p, t, d, i in blocks_of(x)] for x in pdf["html"]],
            })

    kind = dict(pages.dtypes)["page_id"]
    parsed = pages.mapInPandas(cut, f"page_id {kind}, url string, blocks array<struct<path:string,text:string,dropped:boolean,inside:boolean>>")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))
    parsed = stages.save(
        parsed.select("page_id", "url", host.alias("host"), F.expr("transform(blocks, b -> struct(b.text, b.dropped, b.inside, xxhash64(b.path, b.text) as token, xxhash64(b.path) as place))").alias("blocks")), "blocks"
    )
    slots = "filter(blocks, b -> not b.dropped)"
    witnesses = stages.save(
        parsed.select(
            "host", F.expr("xxhash64(transform(blocks, b -> b.token))").alias("copy"),
            F.expr(f"transform({slots}, b -> b.token)").alias("tokens"), F.expr(f"transform({slots}, b -> b.place)").alias("places"),
            F.expr(f"transform({slots}, b -> if({MAIN_TEXT}, length(b.text), 0))").alias("chars"),
        ).dropDuplicates(["host", "copy"]), "witnesses"
    )
    every = "concat(array(struct(0L as token, false as text)), transform(tokens, t -> struct(t as token, true as text)), transform(places, t -> struct(t as token, false as text)))"
    vectors = (
        witnesses.select("host", "copy", F.explode(F.expr(every)).alias("b"))
        .groupBy("host", "copy", "b.text", "b.token").agg(F.count("*").alias("n"))
        .groupBy("host", "text", "token").agg(F.count("*").alias("pages"), F.bit_xor(F.xxhash64("copy", "n")).alias("vector"))
    )
    sizes = witnesses.groupBy("host").agg(F.count("*").alias("all_pages"))
    classes = stages.save(
        vectors.where(F.col("pages") >= least).join(sizes, "host").where(F.col("pages") >= support * F.col("all_pages"))
        .groupBy("host", "vector", "pages").agg(F.count("*").alias("size"), F.sort_array(F.collect_list(F.when(F.col("text"), F.col("token")))).alias("tokens"))
        .where("size >= 2 and size(tokens) > 0").groupBy("host").agg(F.sort_array(F.collect_list("tokens")).alias("classes")), "classes"
    )
    small = (classes.agg(F.sum(F.size(F.flatten("classes")))).first()[0] or 0) <= BROADCAST_TOKENS
    spread = lambda df: F.broadcast(df) if small else df

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for h, t, n, c in zip(pdf["host"], pdf["tokens"], pdf["chars"], pdf["classes"]):
                tokens, groups = list(t), [list(x) for x in c]
                size: dict[int, int] = defaultdict(int)
                for token, chars in zip(tokens, n):
                    size[token] += int(chars)
                total = sum(size.values())
                found += [(h, *e, sum(size[x] for x in groups[e[0]]), total) for e in evidence(tokens, groups)]
            out = pd.DataFrame(found, columns=["host", "number", "order", "crossed", "held", "total"])
            yield out.astype({"number": "int32", "order": "Int64", "crossed": bool, "held": "int64", "total": "int64"})

    valid = (
        witnesses.select("host", "tokens", "chars").join(spread(classes), "host").mapInPandas(judge, "host string, number int, order long, crossed boolean, held long, total long")
        .groupBy("host", "number").agg(
            F.min("order").alias("least"), F.max("order").alias("most"), F.expr("bool_or(crossed or order is null)").alias("bad"), F.sum("held").alias("held"), F.sum("total").alias("total"), F.count("*").alias("pages"),
        )
        .where(f"not bad and least = most and (held <= {HALF} * total or held < {ARTICLE} * pages)").groupBy("host").agg(F.collect_list("number").alias("valid"))
    )
    template = stages.save(
        classes.join(valid, "host").select("host", F.expr("flatten(transform(valid, n -> classes[n]))").alias("template")), "template"
    )
    template = spread(template)
    keep = F.expr(f"filter(blocks, b -> not b.dropped and not array_contains(coalesce(template, array()), b.token) and {MAIN_TEXT})")
    text = F.array_join(F.transform(keep, lambda b: b["text"]), "\n")
    return parsed.join(template, "host", "left").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
