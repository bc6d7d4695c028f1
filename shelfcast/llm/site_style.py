"""Main text of web pages by site style trees.

Pages of one host are merged into a tree whose element nodes are paths of styled blocks
(tag, classes, id).  An element that holds text has, over the host's pages, a distribution of
styles (the sequences of its children) and of contents (its text blocks and link targets).  Both give
entropies: elements presented alike and filled alike on every page are furniture, elements
whose content differs from page to page are the pages' own.  An element's importance is

    (1 - DECAY**l) * entropy of its styles + DECAY**l * mean over contents of (1 - entropy)

with entropies to the base of the number of pages that have it, and l its mean number of child
blocks.  Elements below a threshold are removed from every page of the host; a branch goes when
all its elements go.

Two priors enter the threshold.  What HTML itself declares as furniture (navigation, forms,
scripts, roles and class names such as ``advert`` or ``comments``) has importance 0, and so has
text beside a declared article.  Inside an article, only what is all but the same on every page goes.

Pages of one host with the same text count once, so copies of an article do not make it look
like furniture.  Statistics are grouped sums by (host, path, content); no host is a group of
its own in any task.  Pages are parsed once; their blocks wait in the shared folder.

Cases: null or empty html gives an empty text; pages without a host are no site and keep every
undeclared block; an element on fewer than LEAST_PAGES pages stays; repeated pages give repeated
rows; other columns are ignored; broken markup (unclosed tags, comments or quotes) is read to its end.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import cut_lineage, slices, stored

DECAY = 0.9
LEAST_PAGES = 8       # different pages of a host from which an element's entropies count
BESIDE = 0.2          # least importance outside articles
INSIDE = 0.02         # least importance inside articles
BROADCAST_NODES = 1 << 20  # elements to remove (8 bytes each) that are broadcast; beyond, a join

# What HTML and ARIA declare as no part of the running text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
FURNITURE = frozenset("""nav footer aside form script style noscript template iframe object embed svg canvas button select
    option textarea dialog menu head title audio video applet map datalist noembed noframes xmp""".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar
    toolbar status tooltip tablist""".split())
BLOCKS = frozenset("""html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section
    article main header hgroup figure figcaption blockquote pre fieldset legend address hr details summary
    center""".split()) | (FURNITURE - {"button", "select", "option", "textarea", "map"})
CLOSES_P = BLOCKS - {"html", "body", "head", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "script", "style",
                     "title", "noscript", "template"}
# an opening tag of the first kind ends an open one of the second, up to a container
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
            "body": ({"head"}, {"html"})}
# words of class names and ids that say the same
NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored promo
    promos promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead cookie
    cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login
    share sharing social comment comments disqus reply replies respond related recommended widget widgets toolbar
    pagination pager copyright skip search teaser topbar""".split())

TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LINK = re.compile(r"href\s*=\s*[\"']?([^\"'\s>]+)", re.I)
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://)(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)|^//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)")


def digest(*parts) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url) -> str:
    found = HOST.match(url or "")
    return ((found.group(1) or found.group(2) or "") if found else "").lower().rstrip(".")


class Frame:
    """An open element: its path, whether its text goes, and whether an article is around it."""
    __slots__ = ("tag", "path", "gone", "soft", "article", "children", "links")

    def __init__(self, tag, path, gone, soft, article):
        self.tag, self.path, self.gone, self.soft, self.article = tag, path, gone, soft, article
        self.children, self.links = [], []


def declared(tag: str, attributes: str, article: bool) -> tuple[bool, bool, str]:
    """Whether an element is furniture by its tag or state, whether by its names, and its style."""
    hard = tag in FURNITURE or (tag == "header" and not article)
    if not attributes.strip(" \n\t\r\f/"):
        return hard, False, tag
    soft, style = False, [tag]
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            style.append(f"{name}={' '.join(sorted(DIGITS.sub('#', value).split()))}")
            names = {x.lower() for x in PART.findall(value)}
            soft = soft or tag not in ("html", "body") and (not names.isdisjoint(NAMES) or "header" in names and not article)
        elif name == "role":
            soft = soft or value.lower() in ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            hard = hard or tag not in ("html", "body")
    return hard, soft, "|".join(style)


def blocks(page: str) -> list[tuple[int, bool, str, Frame]]:
    """The text blocks of a page in order: (path, inside an article, text, the element), without
    declared furniture."""
    root = Frame("", digest(""), False, False, False)
    stack, out, held = [root], [], []
    opened = Counter()  # open elements by tag: spares looking for what is not there

    def block():
        return next(f for f in reversed(stack) if f.tag in BLOCKS or not f.tag)

    def flush():
        """Text that is not furniture was held; it ends here as a block of the innermost element."""
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((block(), text))

    def close(k: int):
        if any(f.tag in BLOCKS for f in stack[k:]):
            flush()
        opened.subtract(f.tag for f in stack[k:])
        del stack[k:]

    def push(frame: Frame):
        opened[frame.tag] += 1
        stack.append(frame)

    at, n = 0, len(page)
    while at < n:
        found = TAG.search(page, at)
        if not found:
            if not stack[-1].gone:
                held.append(page[at:])
            break
        if found.start() > at and not stack[-1].gone:
            held.append(page[at:found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name))
            elif name in BLOCKS:
                flush()
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in CLOSES_P and opened["p"]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ("p", "table", "td", "button")), 0)
            if k and stack[k].tag == "p":
                close(k)
        ends, until = SIBLINGS.get(name, ((), ()))
        if any(opened[x] for x in ends):
            k = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in until:
                    break
                if stack[i].tag in ends:
                    k = i
            if k:
                close(k)
        top = stack[-1]
        if name in VOID:
            if name == "hr":
                flush()
            continue
        hard, soft, style = declared(name, found.group(3), top.article)
        own = name in ("article", "main") and not soft and not hard
        gone = (top.gone and not (own and top.soft)) or hard or soft
        # names of an element around an article do not speak for it; a furniture tag does
        yields = not hard and (top.soft if top.gone else soft)
        if name in BLOCKS:
            flush()
            top.children.append(style)
            push(Frame(name, digest(top.path, style), gone, gone and yields, top.article or own))
        else:
            if name == "a" and not top.gone:
                link = LINK.search(found.group(3))
                if link:
                    block().links.append(link.group(1))
            if hard or soft:
                push(Frame(name, top.path, gone, yields, top.article))
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = end.end() if end else n
            if stack[-1].tag == name:
                close(len(stack) - 1)
    flush()
    return [(f.path, f.article, text, f) for f, text in out]


def parse(pages: DataFrame, key: str, url: str, text: str) -> DataFrame:
    """Per page: ``key``, ``url``, ``host``, ``nodes`` and ``texts`` of its blocks, ``sig`` (digest of
    both), and what its elements add to the host's tree: ``stats`` of (node, inside, kind, content, n, l);
    kind 0 is a style, 1 a content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stat = pa.list_(pa.struct([("node", pa.int64()), ("inside", pa.bool_()), ("kind", pa.int32()),
                                   ("content", pa.int64()), ("n", pa.int64()), ("l", pa.int64())]))
        for b in slices(batches, "html"):
            cols = [[] for _ in range(5)]
            for u, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                host = host_of(u)
                found = blocks(h)
                if any(inside for _, inside, _, _ in found):
                    found = [x for x in found if x[1]]  # beside a declared article
                nodes = [digest(host, path) for path, _, _, _ in found]
                texts = [t for _, _, t, _ in found]
                stats, seen = {}, set()
                if host:
                    for node, (_, inside, t, frame) in zip(nodes, found):
                        k = (node, inside, 1, digest(t))
                        stats[k] = stats.get(k, 0) + 1
                        if id(frame) in seen:
                            continue
                        seen.add(id(frame))
                        for link in frame.links:
                            k = (node, inside, 1, digest("href", link))
                            stats[k] = stats.get(k, 0) + 1
                    for node, inside in {(x, f[1]) for x, f in zip(nodes, found)}:
                        frames = {id(f[3]): f[3] for x, f in zip(nodes, found) if x == node}.values()
                        children = [c for f in frames for c in f.children]
                        stats[(node, inside, 0, digest(*dict.fromkeys(children)))] = (1, len(children))
                rows = [{"node": k[0], "inside": k[1], "kind": k[2], "content": k[3],
                         "n": v[0] if k[2] == 0 else v, "l": v[1] if k[2] == 0 else 0} for k, v in stats.items()]
                for c, v in zip(cols, (host, nodes, texts, digest(*nodes, *texts), rows)):
                    c.append(v)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.int64())),
                                   pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.int64()), pa.array(cols[4], stat)],
                                  ["key", "url", "host", "nodes", "texts", "sig", "stats"])

    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "key long, url string, host string, nodes array<long>, texts array<string>, sig long, "
                                "stats array<struct<node: long, inside: boolean, kind: int, content: long, n: long, l: long>>")


def importance(parsed: DataFrame) -> DataFrame:
    """Per element of a site: ``node``, ``inside``, ``pages``, ``importance``."""
    once = (parsed.where(F.size("stats") > 0).select("host", "sig", "stats")
            .groupBy("host", "sig").agg(F.any_value("stats").alias("stats")))  # equal texts have equal statistics
    each = once.select(F.explode("stats").alias("s")).select("s.*")
    n = F.col("n").cast("double")
    per = each.groupBy("node", "inside", "kind", "content").agg(
        F.sum("n").alias("n"), F.sum(n * F.log(n)).alias("nlogn"), F.sum("l").alias("l"))
    n = F.col("n").cast("double")
    style, content = F.col("kind") == 0, F.col("kind") == 1
    node = per.groupBy("node", "inside").agg(
        F.sum(F.when(style, F.col("n"))).alias("pages"), F.sum(F.when(style, F.col("l"))).alias("l"),
        F.sum(F.when(style, n * F.log(n))).alias("styles"), F.count_if(content).alias("contents"),
        F.sum(F.when(content, F.log(n) - F.col("nlogn") / n)).alias("spread"))
    base = F.log(F.col("pages").cast("double"))
    styles = (base - F.col("styles") / F.col("pages")) / base
    contents = 1 - F.col("spread") / F.col("contents") / base
    share = F.pow(F.lit(DECAY), F.col("l") / F.col("pages"))
    return node.select("node", "inside", "pages", F.when(F.col("pages") < 2, 1.0).otherwise(
        (1 - share) * styles + share * contents).alias("importance"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html",
            broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Per page: ``key``, ``url``, ``text``."""
    spark = pages.sparkSession
    parsed = stored(parse(pages, key, url, text))
    floor = F.when(F.col("inside"), INSIDE).otherwise(BESIDE)
    low = cut_lineage(importance(parsed).where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < floor)).select("node"))
    joined = lambda kept: F.array_join(F.transform(kept, lambda b: b["texts"]), "\n")
    pairs = F.arrays_zip("nodes", "texts")
    if low.count() <= broadcast_nodes:
        gone = spark.sparkContext.broadcast(np.sort(low.toArrow().column("node").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "joined"):
                out = []
                for nodes, texts in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    keep = ~np.isin(np.array(nodes, np.int64), gone.value)
                    out.append("\n".join(t for t, k in zip(texts, keep.tolist()) if k))
                yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.string())], ["key", "url", "text"])

        if not len(gone.value):
            clean = parsed.select("key", "url", F.array_join("texts", "\n").alias("text"))
        else:
            clean = (parsed.select("key", "url", "nodes", "texts", F.array_join("texts", "\n").alias("joined"))
                     .mapInArrow(run, "key long, url string, text string"))
    else:  # the table is written: its rows keep their numbers
        rows = parsed.select("key", "url", "nodes", "texts").withColumn("_row", F.monotonically_increasing_id())
        drop = (rows.select("_row", F.explode(F.array_distinct("nodes")).alias("node")).join(low, "node")
                .groupBy("_row").agg(F.collect_set("node").alias("_drop")))  # elements of one page
        kept = F.filter(pairs, lambda b: ~F.array_contains(F.coalesce("_drop", F.array().cast("array<long>")), b["nodes"]))
        clean = rows.join(drop, "_row", "left").select("key", "url", joined(kept).alias("text"))
    return clean.select(F.col("key").alias(key), F.col("url").alias(url), "text")
