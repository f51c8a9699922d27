"""Main text of web pages by union-free wrappers inferred per host.

A page becomes nested streams of tokens: block elements and texts. Neighbouring elements with one
label become a repeated element. The wrapper of a host is the page streams aligned one after the
other, level by level: what only one side has becomes optional, repeated elements stay repeated, and
texts that differ become a text slot, while equal ones stay template text. Tasks align what they read,
their wrappers are aligned in two steps; a wrapper covers every page of its host that is not empty and
counts the pages that have each part. A page is then
aligned with its host's wrapper, and the texts that meet main slots are its main text.

The wrapper says where main slots lie: article and main elements, or the body around them, whichever has
the longer slot text over all pages of the host, the body's counting half. (Where no place varies, as on a host
of one page, all its text counts.) So an article element that only holds a teaser does not hide the
article. A page without text there gives the text of the other region. Never main are menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments, known by element, role or class, and
template text: in the body always, in article and main elements where the host has ``EVIDENCE`` pages or
more and template text is at most a fifth of theirs (pages with more in common are copies). Equal text in a run of
repeated elements, as one of several paragraphs, has no place of its own and is kept.

Null html has an empty text, as has a page without main text. A null or odd url is a host of its own.
Elements nested deeper than ``DEPTH`` are seen as part of their parent, but their end tags close only
them, and whether a text is in an aside or main element among them is kept. Rows may repeat; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import Counter
from typing import NamedTuple
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stored

DEPTH = 100
#: Partial wrappers of a host are aligned within this many groups first.
SPREAD = 16
#: Share of a host's pages that must have a place for its text to be template text.
SHARE = 0.8
#: Pages a host must have for equal text inside its articles to be template text.
EVIDENCE = 5
#: Largest share of the articles' text that can be template text.
COMMON = 0.2
#: Slot text of the body counts as this share of slot text in article and main elements.
BODY = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|title|object|math)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_IN_PARAGRAPH = frozenset({"p"})
_ASIDE_ELEMENTS = frozenset("head nav header footer aside form button menu dialog label fieldset".split())
_ASIDE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar".split())
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead topbar footer comment comments disqus respond reply replies cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "widget toolbar pagination pager".split()
)

# A node is [label, optional, repeated, text, children, pages that have it, characters of a text over
# these pages]; label "#" is a text: ``text`` is its checksum
# in a page or as template text, None for a slot. In a page a text's children are its numbers.
LABEL, OPTIONAL, REPEATED, TEXT, INSIDE, PAGES, CHARS = range(7)


def _label(name: str, rest: str) -> str:
    """Element name, role and class; of an id only what tells an aside, as ids may name a single page."""
    found = []
    for kind, a, b, c in _ATTRIBUTE.findall(rest) if "=" in rest else ():
        words = (a or b or c).lower()
        if kind.lower() == "id":
            words = " ".join(_ASIDE_WORDS.intersection(re.split(r"[^a-z]+", words)))
            if not words:
                continue
        found.append(f"{kind.lower()}={' '.join(sorted(words.split()))}")
    return ";".join([name, *(re.sub(r"\d+", "0", attribute) for attribute in sorted(found))])


def _aside(label: str) -> bool:
    name, *attributes = label.split(";")
    if name in _ASIDE_ELEMENTS:
        return True
    for attribute in attributes:
        kind, _, value = attribute.partition("=")
        if kind == "role" and value in _ASIDE_ROLES:
            return True
        if kind != "role" and name not in ("html", "body") and _ASIDE_WORDS.intersection(re.split(r"[^a-z]+", value)):
            return True
    return False


def _main(label: str) -> bool:
    name, *attributes = label.split(";")
    return name in ("article", "main") or "role=main" in attributes


def parse(page: str) -> tuple[list, list[str]]:
    """Tree of a page with neighbouring equal labels joined, and its texts in page order."""
    root = ["", False, False, None, [], 1, 0]
    stack, names, texts, piece = [root], [""], [], []
    # Open elements beyond DEPTH: name and kind ("aside", "main" or none); how many there are of each.
    over: list[tuple[str, str]] = []
    beyond: Counter = Counter()
    kinds: Counter = Counter()

    def leave() -> str:
        name, kind = over.pop()
        beyond[name] -= 1
        kinds[kind] -= 1
        return name

    def flush():
        text = _SPACE.sub(" ", references.unescape("".join(piece))).strip()
        piece.clear()
        if text:
            node = ["#", False, False, crc32(text.encode("utf-8", "replace")), [len(texts)], 1, len(text)]
            kind = "aside" if kinds["aside"] else "main" if kinds["main"] else ""
            stack[-1][INSIDE].append([kind, False, False, None, [node], 1, 0] if kind else node)
            texts.append(text)

    at = 0
    for token in _TOKEN.finditer(page):
        piece.append(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in _VOID:
            piece.append(" " if name in ("br", "hr") else "")
            continue
        ends = bool(token["end"])
        if name in _INLINE:
            if ends:
                if (over[-1][0] if over else names[-1]) != name:
                    continue
            elif not (token["rest"] and _aside(_label(name, token["rest"]))):
                continue
        flush()
        if ends:
            if beyond[name]:
                while leave() != name:
                    pass
            elif name in names and name not in ("html", "body"):
                while over:
                    leave()
                while names.pop() != name:
                    stack.pop()
                stack.pop()
            continue
        last = over[-1][0] if over else names[-1]
        closes = _CLOSES.get(name, ()) if last != "p" else _IN_PARAGRAPH | _CLOSES.get(name, set())
        while over and over[-1][0] in closes:
            leave()
        while not over and names[-1] in closes and len(names) > 1:
            names.pop()
            stack.pop()
        if len(stack) < DEPTH:
            node = [_label(name, token["rest"]), False, False, None, [], 1, 0]
            stack[-1][INSIDE].append(node)
            stack.append(node)
            names.append(name)
        else:
            label = _label(name, token["rest"])
            kind = "aside" if _aside(label) else "main" if _main(label) else ""
            over.append((name, kind))
            beyond[name] += 1
            kinds[kind] += 1
    piece.append(page[at:])
    flush()
    fold(root)
    return root, texts


def fold(node: list) -> None:
    """Join neighbouring children with one label, from the leaves up."""
    joined: list = []
    for child in node[INSIDE]:
        if child[LABEL] != "#":
            fold(child)
        if joined and joined[-1][LABEL] == child[LABEL] and child[LABEL] != "#":
            joined[-1] = align(joined[-1], child, within=True)
            joined[-1][REPEATED] = True
        else:
            joined.append(child)
    node[INSIDE] = joined


def matching(one: list, two: list) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence of two child lists by label, with what only one side has."""
    if [c[LABEL] for c in one] == [c[LABEL] for c in two]:
        return [(i, i) for i in range(len(one))]
    n, m = len(one), len(two)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if one[i][LABEL] == two[j][LABEL] else max(best[i + 1][j], best[i][j + 1])
    pairs: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and one[i][LABEL] == two[j][LABEL]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            pairs.append((i, None))
            i += 1
        else:
            pairs.append((None, j))
            j += 1
    return pairs


def align(one: list, two: list, within: bool = False) -> list:
    """Smallest common wrapper of two nodes with one label; texts of a page keep their numbers.

    ``within``: both are of one page, so a page counts once.
    """
    pages = max(one[PAGES], two[PAGES]) if within else one[PAGES] + two[PAGES]
    if one[LABEL] == "#":
        return ["#", one[OPTIONAL] or two[OPTIONAL], False, one[TEXT] if one[TEXT] == two[TEXT] else None, one[INSIDE] + two[INSIDE], pages, one[CHARS] + two[CHARS]]
    inside = []
    for i, j in matching(one[INSIDE], two[INSIDE]):
        if i is not None and j is not None:
            inside.append(align(one[INSIDE][i], two[INSIDE][j], within))
        else:
            only = one[INSIDE][i] if j is None else two[INSIDE][j]
            inside.append([only[LABEL], True, *only[REPEATED:]])
    return [one[LABEL], one[OPTIONAL] or two[OPTIONAL], one[REPEATED] or two[REPEATED], None, inside, pages, 0]


def bare(node: list) -> list:
    """The node without the numbers of a page's texts."""
    inside = [] if node[LABEL] == "#" else [bare(child) for child in node[INSIDE]]
    return [*node[:INSIDE], inside, *node[PAGES:]]


class Wrapper(NamedTuple):
    """A host's wrapper and what its slots say of the host's pages."""

    rule: list | None
    #: Main text lies in article and main elements rather than in the body around them.
    articles: bool = True
    #: Equal texts inside articles are template text.
    trimmed: bool = False
    #: The region was chosen by slots, texts that vary from page to page.
    by_slots: bool = False


def always_there(rule: list, pages: int) -> bool:
    """Nearly every page of the host has this place, and once."""
    return rule[PAGES] >= SHARE * pages and not rule[REPEATED]


def judged(rule: list | None) -> Wrapper:
    """Measures the regions of a wrapper by the text of their slots."""
    if rule is None:
        return Wrapper(None)
    slots, template, varies = Counter(), Counter(), Counter()

    def walk(node: list, main: bool, always: bool) -> None:
        always = always and always_there(node, rule[PAGES])
        if node[LABEL] == "#":
            if always and node[TEXT] is not None:
                template[main] += node[CHARS]
            else:
                slots[main] += node[CHARS]
                varies[main] += always
        elif not _aside(node[LABEL]):
            for child in node[INSIDE]:
                walk(child, main or _main(node[LABEL]), always)

    walk(rule, False, True)
    varied = bool(varies[True] or varies[False])
    inside, outside = (slots[main] + (0 if varied else template[main]) for main in (True, False))
    few = template[True] <= COMMON * (template[True] + slots[True])
    return Wrapper(rule, outside * BODY <= inside, rule[PAGES] >= EVIDENCE and varies[True] > 0 and few, varied)


def main_texts(page: list, wrapper: Wrapper) -> list[int]:
    """Numbers of the page's texts that meet main slots of the wrapper."""
    found: dict[bool, list[int]] = {True: [], False: []}
    template: set[int] = set()
    varied = False
    pages = wrapper.rule[PAGES] if wrapper.rule else 0

    def walk(node: list, rule: list | None, main: bool, always: bool) -> None:
        nonlocal varied
        always = always and rule is not None and always_there(rule, pages)
        if node[LABEL] == "#":
            found[main].extend(node[INSIDE])
            if always and rule[TEXT] is not None:
                template.update(node[INSIDE])
            elif always:
                varied = True
            return
        if _aside(node[LABEL]):
            return
        rules = rule[INSIDE] if rule else []
        for i, j in matching(node[INSIDE], rules):
            if i is not None:
                walk(node[INSIDE][i], None if j is None else rules[j], main or _main(node[LABEL]), always)

    walk(page, wrapper.rule, False, True)
    for main in (wrapper.articles, not wrapper.articles):
        # Where no place of the body varies, the pages of the host are copies, and equal texts say nothing.
        left_out = template if (wrapper.trimmed if main else varied) else set()
        kept = sorted(number for number in found[main] if number not in left_out)
        if kept:
            return kept
    return []


def _host():
    return F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit(""))


def infer(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) from all pages."""

    def read(stream):
        found: dict[str, list] = {}
        for batch in stream:
            for host, page in zip(batch["host"].to_pylist(), batch["html"]):
                tree = bare(parse(page.as_py() or "")[0])
                if not tree[INSIDE]:
                    continue
                found[host] = align(found[host], tree) if host in found else tree
        hosts = list(found)
        for first in range(0, len(hosts), 256):
            some = hosts[first : first + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([json.dumps(found[h]) for h in some], pa.string())], names=["host", "wrapper"])

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(group["wrapper"]):
            whole = json.loads(text) if whole is None else align(whole, json.loads(text))
        return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(whole)]})

    parts = pages.select(_host().alias("host"), "html").mapInArrow(read, "host string, wrapper string")
    spread = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD)))
    some = spread.groupBy("host", "part").applyInPandas(joined, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(joined, "host string, wrapper string")


def extract(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """page_id, url, main ``text`` of every page, and whether its place was chosen ``by_slots``.

    Wrappers are stored: where they are small, Spark knows their size and sends them to the pages
    instead of shuffling these.
    """

    def read(stream):
        known: dict[str, Wrapper] = {}
        for batch in stream:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                out, by_slots = [], []
                for page, wrapper in zip(some["html"], some["wrapper"].to_pylist()):
                    if wrapper not in known:
                        known = {} if len(known) > 5_000 else known
                        known[wrapper] = judged(json.loads(wrapper) if wrapper else None)
                    tree, texts = parse(page.as_py() or "")
                    out.append(" ".join(texts[number] for number in main_texts(tree, known[wrapper])))
                    by_slots.append(known[wrapper].by_slots)
                columns = [some["page_id"], some["url"], pa.array(out, pa.string()), pa.array(by_slots, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "by_slots"])

    joined = pages.select(F.col("page_id").cast("long"), "url", "html", _host().alias("host")).join(wrappers, "host", "left")
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(read, "page_id long, url string, text string, by_slots boolean")


def main_text(pages: DataFrame) -> DataFrame:
    return extract(pages, stored(infer(pages), "wrappers"))
