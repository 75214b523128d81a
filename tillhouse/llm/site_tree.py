"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: an element node is known by its path of tags, ids and classes, and holds how
its children were arranged on how many pages, its presentation styles.  Text that stands directly in an element is a leaf,
which holds its contents and on how many pages each occurred.  Importance is entropy.  An element arranged alike on all pages
has none, one arranged anew on each has all; a leaf whose contents are on every page has none.  The composite importance of
an element adds that of its branches, the less the fewer styles it has.

What markup itself declares weighs in: the importance of elements declared as navigation, forms, comments and the like, and
of all that they hold, is scaled down; the unimportance of those declared as article is.  From the top, a branch that is
important stays whole, but for declared parts; of others, what is important stays, and the rest is removed.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from tillhouse.functions.materialize import stored
from tillhouse.llm.blocks import rows_in_blocks
from tillhouse.llm.common import free_name

GAMMA = 0.9
THRESHOLD = 0.4
DECLARED = 0.25  # what is left of the importance of declared noise, and of the unimportance of declared content
LEAST_PAGES = 8  # with content of their own, before a host's tree judges a node
BLOCK_BYTES = 8 << 20

# Elements of HTML by how they are read (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label map mark meter "
    "nobr output picture progress q rp rt ruby s samp select small span strike strong sub sup svg time tt u var wbr".split()
)
CLOSE_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# A start tag that ends an open element of these, unless one of the others stands between them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
TOP = {"table", "td", "th", "caption", "button", "object"}  # an open p outside of these isn't closed from inside

# What tags and the words of classes, ids and roles declare (fixed values).
NOISE_TAGS = set("head nav footer aside form header button select option svg noscript template dialog menu".split())
CONTENT_TAGS = {"article", "main"}
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar aside widget widgets notice notices cookie cookies consent gdpr banner popup "
    "modal overlay alert toolbar share sharing social related recommended newsletter subscribe subscription signup login "
    "search pagination pager comment comments disqus reply replies respond skip copyright complementary contentinfo".split()
)

TOKEN = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*+(?:>|\Z)|/?([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>)""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Block-level elements in page order, each with the place of its parent, and the texts that they hold."""

    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: [""])
    words: list[set[str]] = field(default_factory=lambda: [set()])
    tags: list[str] = field(default_factory=lambda: [""])
    texts: list[tuple[int, str]] = field(default_factory=list)


def _attributes(written: str) -> tuple[str, set[str], bool]:
    """The id and classes, in order and without numbers; the words in them and in the role; whether the element is hidden."""
    found = {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in reversed([*ATTRIBUTE.finditer(written)])}
    names = sorted(found.get("class", "").split())
    label = "#" + found.get("id", "") + "".join(f".{name}" for name in names)
    said = " ".join([found.get("id", ""), *names, found.get("role", "")])
    words = set(WORD.findall(said.lower())) | set(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", said).lower()))
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    return re.sub(r"[0-9]+", "0", label) if label != "#" else "", words, hidden


def parse(source: str) -> Page:
    """Reads a page with the end tags that HTML lets authors leave out; what is no tag is text."""
    page = Page()
    stack: list[tuple[str, int]] = [("", 0)]  # open elements: the tag, and the place of the block or -1
    inside = [0]  # places of open blocks
    muted = 0  # open inline elements that declare noise
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            page.texts.append((inside[-1], text))

    def end(down_to: int) -> None:
        nonlocal muted
        while len(stack) > down_to:
            _, place = stack.pop()
            if place >= 0:
                flush()
                inside.pop()
            elif place == -2:
                muted -= 1

    def open_at(tags: set[str], stops: set[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in stops:
                break
        return 0

    at, stop = 0, source.rfind(">") + 1
    while at < len(source):
        token = TOKEN.search(source, at, stop)
        text = source[at : token.start() if token else len(source)]
        if not token:  # a tag that the end of the page cuts off is none
            cut = re.search(r"<[A-Za-z/!?]", text)
            text = text[: cut.start()] if cut else text
        if text and not muted:
            held.append(references.unescape(text) if "&" in text else text)
        if not token:
            break
        at = token.end()
        if not token[1]:
            continue
        tag = token[1].lower()
        if token[0][1] == "/":
            k = open_at({tag}, set())
            if k and tag in INLINE:  # blocks that it overlaps stay open
                muted -= stack[k][1] == -2
                del stack[k]
            elif k:
                end(k)
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            at = close.start() if close else len(source)
            continue
        if tag in ("html", "body") and any(name == tag for name, _ in stack):
            continue
        if tag in VOID:
            if tag == "br":
                held.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in CLOSE_P and (k := open_at({"p"}, TOP)):
            end(k)
        if tag in IMPLIED and (k := open_at(*IMPLIED[tag])):
            end(k)
        label, words, hidden = _attributes(token[2]) if token[2] else ("", set(), False)
        if tag in INLINE:
            mute = hidden or tag in NOISE_TAGS or bool(words & NOISE_WORDS)
            muted += mute
            stack.append((tag, -2 if mute else -1))
            continue
        flush()
        page.parents.append(inside[-1])
        page.labels.append(tag + label)
        page.words.append(words | {"hidden"} if hidden else words)
        page.tags.append(tag)
        stack.append((tag, len(page.tags) - 1))
        inside.append(len(page.tags) - 1)
    end(0)
    return page


def declared(page: Page) -> list[int]:
    """-1 for elements in declared noise, 1 in declared content, 0 otherwise; what stands nearer counts, but in noise all is.

    Classes declare nothing for an element that holds the main part or heading of the page, which some name by their layout.
    """
    holds = [False] * len(page.tags)
    for k in range(len(page.tags) - 1, 0, -1):
        if holds[k] or page.tags[k] in ("main", "h1", "body"):
            holds[page.parents[k]] = True
    out = [0] * len(page.tags)
    for k in range(1, len(page.tags)):
        above, tag = out[page.parents[k]], page.tags[k]
        words = set() if holds[k] or tag in ("html", "body", "main", "h1") else page.words[k] & NOISE_WORDS
        noise = "hidden" in page.words[k] or tag in NOISE_TAGS and not (tag == "header" and above > 0) or words
        out[k] = -1 if above < 0 or noise else 1 if tag in CONTENT_TAGS else above
    return out


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))


def node_keys(page: Page) -> list[int]:
    """The key of each element's path; its text is the leaf of the key plus one."""
    keys = [0]
    for k in range(1, len(page.labels)):
        keys.append(_hash(f"{keys[page.parents[k]]} {page.labels[k]}") & ~1)
    return keys


def features(page: Page) -> tuple[int, set[tuple[int, int]]]:
    """What tells the page's content from that of other pages, and its (node, style or content).

    The styles of elements with one path are one style.  A leaf has the feature 0 besides its contents.
    """
    keys, noise = node_keys(page), declared(page)
    arranged: dict[int, list[str]] = {}
    last = {}
    for k in range(1, len(keys)):
        parent = page.parents[k]
        style = arranged.setdefault(keys[parent], [])
        if last.get(keys[parent], parent) != parent:
            style.append("")  # the next element with the same path
        last[keys[parent]] = parent
        style.append(page.labels[k])
    out = {(key, _hash("\n".join(style))) for key, style in arranged.items()}
    for place, text in page.texts:
        out.add((keys[place] + 1, 0))
        out.add((keys[place] + 1, _hash(text) | 1))
    main = max((text for place, text in page.texts if noise[place] >= 0), key=len, default="")
    return _hash(main), out


def kept_texts(page: Page, site: dict[int, tuple[float, int]], gamma: float, threshold: float) -> list[str]:
    """The texts outside of removed branches; ``site`` has importance and number of styles of nodes, others count as new."""
    keys, said = node_keys(page), declared(page)

    def importance(k: int, key: int) -> float:
        value = site.get(key, (1.0, 1))[0]
        return value * DECLARED if said[k] < 0 else 1 - (1 - value) * DECLARED if said[k] > 0 else value

    below: list[list[float]] = [[] for _ in keys]
    for place in {place for place, _ in page.texts}:
        below[place].append(importance(place, keys[place] + 1))
    composite = [0.0] * len(keys)
    for k in range(len(keys) - 1, -1, -1):
        if below[k]:
            own = gamma ** site.get(keys[k], (1.0, 1))[1]
            composite[k] = (1 - own) * sum(below[k]) / len(below[k]) + own * importance(k, keys[k])
            if k:
                below[page.parents[k]].append(composite[k])
    whole = [False] * len(keys)
    for k in range(1, len(keys)):
        # elements above the page's body aren't judged: what they hold is the page
        judged = page.tags[k] not in ("html", "body") and said[k] >= 0
        whole[k] = said[k] >= 0 and (whole[page.parents[k]] or judged and composite[k] >= threshold and keys[k] in site)
    return [
        text for place, text in page.texts
        if said[place] >= 0 and (whole[place] or importance(place, keys[place] + 1) >= threshold)
    ]


def host_of(url: Column) -> Column:
    """The host in lower case; an empty string where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def site_trees(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per host the nodes that its pages share: (host, nodes: key, importance, styles).

    Pages whose longest text is equal count once, so that copies of an article aren't taken for what a site repeats.  A node
    counts once there are ``least_pages`` of them; those of full importance are left out.  Styles and contents are counted by
    host and node, with partial aggregation, so that a host with a third of all pages is spread over its nodes' features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_in_blocks(batches, "html", BLOCK_BYTES):
            seen: set[tuple[str, int, int, int]] = set()
            for host, source in zip(rows["host"].to_pylist(), rows["html"].to_pylist()):
                page, found = features(parse(source or ""))
                seen.update((host, page, node, feature) for node, feature in found)
            if seen:
                host, *numbers = zip(*seen)
                columns = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in numbers]
                yield from pa.table([pa.array(host, pa.string()), *columns], ["host", "page", "node", "feature"]).to_batches()

    chosen = pages.select(host_of(pages[url]).alias("host"), pages[html].cast("string").alias("html")).where("host <> ''")
    found = chosen.mapInArrow(run, "host string, page long, node long, feature long").distinct()
    n = F.count(F.lit(1))
    counts = found.groupBy("host", "node", "feature").agg(n.alias("n"))
    leaf, there = F.col("node").bitwiseAND(1) == 1, F.col("feature") == 0
    bits = F.col("n") * F.log("n")
    nodes = counts.groupBy("host", "node").agg(
        F.when(F.first(leaf), F.max(F.when(there, F.col("n")))).otherwise(F.sum("n")).alias("pages"),
        F.avg(F.when(~there, F.log("n"))).alias("shared"),
        F.sum(bits).alias("ordered"),
        F.count(F.lit(1)).cast("int").alias("styles"),
        F.first(leaf).alias("leaf"),
    )
    whole = F.log("pages")
    importance = F.when(F.col("leaf"), 1 - F.col("shared") / whole).otherwise(1 - F.col("ordered") / F.col("pages") / whole)
    known = nodes.where(F.col("pages") >= max(least_pages, 2)).withColumn("importance", importance)
    listed = F.collect_list(F.struct("node", "importance", "styles")).alias("nodes")
    return known.where(F.col("importance") < 1 - 1e-9).groupBy("host").agg(listed)


def extract_main_text(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    least_pages: int = LEAST_PAGES,
    gamma: float = GAMMA,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``pages`` with the main text of ``html`` in a column ``main_text``, with underscores in front if need be.

    Character references are decoded, white space in a block becomes one space, blocks in page order are joined by an empty
    line.  Null and empty pages, and those without main text, give an empty string.  Pages without a host are judged by what
    their markup declares.  Repeated rows stay repeated, other columns as they are; an empty table gives no rows.
    """
    trees = stored(site_trees(pages, url, html, least_pages), "site-trees")
    host, nodes, out = (free_name(name, pages.columns) for name in ("host", "nodes", "main_text"))
    joined = pages.withColumn(host, host_of(pages[url])).join(
        trees.select(F.col("host").alias(host), F.col("nodes").alias(nodes)), host, "left"
    )
    names = pages.columns
    arrow = [to_arrow_type(pages.schema[name].dataType) for name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sites: dict[str, dict[int, tuple[float, int]]] = {}
        for rows in rows_in_blocks(batches, html, BLOCK_BYTES):
            texts = []
            sites.clear()
            for k, (name, source) in enumerate(zip(rows[host].to_pylist(), rows[html].to_pylist())):
                if name not in sites:
                    found = rows[nodes][k].as_py() or []
                    sites[name] = {x["node"] % (1 << 64): (x["importance"], x["styles"]) for x in found}
                texts.append("\n\n".join(kept_texts(parse(source or ""), sites[name], gamma, threshold)))
            columns = [rows[name].cast(kind) for name, kind in zip(names, arrow)]
            yield from pa.table([*columns, pa.array(texts, pa.string())], [*names, out]).to_batches(max_chunksize=2_000)

    schema = StructType([*pages.schema.fields, StructField(out, StringType())])
    return joined.select(*names, host, nodes).mapInArrow(run, schema)
