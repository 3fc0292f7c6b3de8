"""Main text of web pages by wrapper induction.

Pages of one host are made by few templates. Pages are folded (siblings of the same
element and label become one node, so a list of any length is one slot), pages of a host
are reduced to different trees and dealt to blocks of about ``BLOCK_PAGES``, and in a block neighbouring trees are
aligned by simple tree matching. Each aligned node votes whether both pages hold the
same text there (template) or different text (slot). Votes of all blocks of a host are
added, so all pages of a host count however many they are; pairs of pages with the same
main text do not vote, as copies say nothing about the template. The wrapper of a host
is the list of its constant nodes.

The main text is what varies: the text of the article or main elements, or of the body
where a page has neither, without constant nodes and without elements that HTML or their
names mark as menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or comments. Unlabelled nodes of an article (a heading or paragraph that all pages
of a host happen to share) are content in any case.
"""
import json
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import BLOCK, RAW, VOID, parsed
from .store import small, stored
from .urls import host_of

BLOCK_PAGES, VOTES, CONSTANT, PRESENT, DEPTH = 64, 5, 0.8, 0.3, 60
# Elements, roles and name parts that mark what is not main text.
APART = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "link", "meta"} | RAW
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
         "menu", "menubar", "hidden"}
NAMES = set("""nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead sidebar widget widgets ad ads
advert adverts advertisement adsense adslot sponsor sponsored promo promotion cookie cookies consent gdpr notice
notices popup modal newsletter subscribe subscription signup login comment comments disqus reply replies respond share sharing
social related recommended recommendations pagination pager toolbar skip topbar""".split())
OUTSIDE = {"header", "banner"}  # only outside an article
MAIN = {"article", "main"}
# Names that topics bear as well, and those of reader comments unless they state whether one may comment.
TOPICS = {"related", "recommended", "social", "share", "sharing", "notice", "notices", "promotion", "subscription"}
COMMENTS = {"comment", "comments", "reply", "replies"}
STATES = {"open", "closed", "enabled", "disabled", "has", "no"}
_PART = re.compile(r"[A-Za-z]+")
_DIGITS = re.compile(r"[0-9]+")


def name_parts(label: str) -> set:
    """Words of class and id, parted at signs, numbers and capitals."""
    return {p.lower() for p in _PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", label))}


def is_comment(node) -> bool:
    """An article that by its name is a reader comment."""
    parts = name_parts(node.label)
    return bool(parts & COMMENTS) and not parts & STATES


def is_prose(node) -> bool:
    """Holds more text in paragraphs than in links."""
    prose, links, todo = 0, 0, [(node, False, False)]
    while todo:
        n, in_paragraph, in_link = todo.pop()
        for c in n.children:
            if not isinstance(c, str):
                todo.append((c, in_paragraph or c.tag in ("p", "blockquote", "pre"), in_link or c.tag == "a"))
            elif in_link:
                links += len(c.strip())
            elif in_paragraph:
                prose += len(c.strip())
    return prose > links


def containers(root) -> tuple[set, set]:
    """Nodes that hold a main element, and those that hold an article outside of articles, with both themselves.

    Articles that are reader comments do not count beside others.
    """
    found, todo = [], [(root, False)]
    while todo:
        node, within = todo.pop()
        if node.tag == "main" or node.tag == "article" and not within:
            found.append(node)
        within = within or node.tag == "article"
        todo.extend((c, within) for c in node.children if not isinstance(c, str))
    own = [n for n in found if n.tag == "article" and not is_comment(n)]
    mains, articles = set(), set()
    for node in found:
        if node.tag == "article" and own and is_comment(node):
            continue
        into, up = mains if node.tag == "main" else articles, node
        while up is not None and id(up) not in into:
            into.add(id(up))
            up = up.parent
    return mains, articles


def set_apart(node, in_article: bool, holding=(frozenset(), frozenset()), whole: bool = False,
              forms: bool = True) -> bool:
    """Marked by element, role or name as something else than main text.

    Names do not count for the page, its body and what holds a main element. For what holds
    an article, and everywhere if ``whole``, only a class or id that is a name as a whole
    counts: ``comments``, but not ``has-comments``. Inside an article, names that topics bear too
    (``related-work``) do not count for what is mostly paragraphs, unless they are the whole name.
    A form around a main element or an article is as the body, and any form if not ``forms``.
    """
    page_form = node.tag == "form" and (not forms or id(node) in holding[0] or id(node) in holding[1])
    if (node.tag in APART or node.role in ROLES) and not page_form:
        return True
    if not in_article and node.tag == "header":
        return True
    if not node.label or node.tag in ("html", "body") or id(node) in holding[0]:
        return False
    if whole or id(node) in holding[1]:
        names = set(node.label.lower().split())
        return bool(names & NAMES) or (not in_article and bool(names & OUTSIDE))
    parts = name_parts(node.label) & NAMES
    if in_article and parts and parts <= TOPICS and not set(node.label.lower().split()) & NAMES and is_prose(node):
        return False
    return bool(parts) or (not in_article and bool(name_parts(node.label) & OUTSIDE))


def step_of(node) -> str:
    """An element and its label with numbers taken out."""
    label = _DIGITS.sub("", node.label)
    return f"{node.tag}.{' '.join(sorted(label.split()))}" if label else node.tag


def folded(root):
    """``[step, hash of own text, length, children]``, siblings of equal steps in one node."""
    out = ["", [], {}]
    todo = [(root, out, 0)]
    while todo:
        node, into, depth = todo.pop()
        for child in node.children:
            if isinstance(child, str):
                text = " ".join(child.split())
                if text:
                    into[1].append(text)
            elif child.tag not in RAW and child.tag not in VOID:
                if child.tag in BLOCK and depth < DEPTH:
                    step = step_of(child)
                    held = into[2].setdefault(step, [step, [], {}])
                    todo.append((child, held, depth + 1))
                else:
                    todo.append((child, into, depth))
    return _packed(out)


def _packed(node):
    # Without recursion: children are finished before their parent.
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(n[2].values())
    done = {}
    for n in reversed(order):
        text = " ".join(sorted(n[1]))
        done[id(n)] = [n[0], zlib.crc32(text.encode("utf-8", "replace")) if text else 0, len(text),
                       [done[id(c)] for c in n[2].values()]]
    return done[id(node)]


def main_hash(tree) -> int:
    """Hash of the three longest texts, the same for pages with the same main text."""
    texts, todo = [], [tree]
    while todo:
        n = todo.pop()
        texts.append((n[2], n[1]))
        todo.extend(n[3])
    return zlib.crc32(repr(sorted(texts, reverse=True)[:3]).encode())


def matched(a, b):
    """Simple tree matching: (weight, pairs of aligned nodes) of two folded trees."""
    if a[0] != b[0]:
        return 0, []
    weight, pairs = 1, [(a, b)]
    mine, theirs = a[3], b[3]
    by_step = {c[0]: c for c in theirs}
    if all(c[0] in by_step for c in mine) and len(mine) == len(theirs):  # the same children: no choice to make
        for c in mine:
            w, p = matched(c, by_step[c[0]])
            weight, pairs = weight + w, pairs + p
        return weight, pairs
    # Longest weighted common sequence of the children, elements equal or alike but for the label.
    got = {}
    best = [[0] * (len(theirs) + 1) for _ in range(len(mine) + 1)]
    for i, x in enumerate(mine):
        for j, y in enumerate(theirs):
            w = 0
            if x[0] == y[0] or x[0].split(".")[0] == y[0].split(".")[0]:
                got[i, j] = matched(x, [x[0], *y[1:]])
                w = got[i, j][0] + (x[0] == y[0])
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
    i, j = len(mine), len(theirs)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            weight, pairs = weight + got[i - 1, j - 1][0], pairs + got[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return weight, pairs


def _paths(tree):
    out, todo = {}, [(tree, "")]
    while todo:
        n, path = todo.pop()
        path = f"{path}/{n[0]}"
        out[id(n)] = path
        todo.extend((c, path) for c in n[3])
    return out


def _votes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Votes of one block: neighbouring pages in order of a hash, each with the next."""
    pdf = pdf.sort_values(["sig", "tree"])
    trees = [json.loads(t) for t in pdf["tree"]]
    sigs, count = pdf["sig"].tolist(), {}
    for a, b, same in zip(trees, trees[1:], [x == y for x, y in zip(sigs, sigs[1:])]):
        if same:
            continue
        paths = _paths(a)
        for x, y in matched(a, b)[1]:
            if x[2] or y[2]:
                c = count.setdefault(paths[id(x)], [0, 0])
                c[x[1] != y[1]] += 1
    pairs = sum(x != y for x, y in zip(sigs, sigs[1:]))
    return pd.DataFrame([(pdf["host"].iloc[0], p, k, v, pairs) for p, (k, v) in count.items()],
                        columns=["host", "path", "constant", "varying", "pairs"])


def induced(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, template)``: the constant nodes of every host that has any."""
    host = host_of(F.col(f"`{url}`"))
    rows = pages.select(F.coalesce(host, F.lit("")).alias("host"), F.col(f"`{html}`").alias("html")).filter("html IS NOT NULL")

    def fold(batches):
        for pdf in batches:
            trees = [folded(parsed(h)) for h in pdf["html"]]
            yield pd.DataFrame({"host": pdf["host"], "sig": [main_hash(t) for t in trees],
                                "tree": [json.dumps(t, separators=(",", ":")) for t in trees]})

    # Copies do not vote, and would all fall into one block.
    trees = stored(rows.mapInPandas(fold, "host string, sig long, tree string").distinct())
    sizes = trees.groupBy("host").agg(F.ceil(F.count("*") / BLOCK_PAGES).alias("blocks"))
    dealt = trees.join(small(sizes), "host").withColumn("block", F.pmod(F.xxhash64("tree"), "blocks"))
    votes = dealt.groupBy("host", "block").applyInPandas(
        lambda pdf: _votes(pdf), "host string, path string, constant long, varying long, pairs long")
    nodes = stored(votes).groupBy("host", "path").agg(F.sum("constant").alias("k"), F.sum("varying").alias("v"))
    most = nodes.groupBy("host").agg(F.max(F.col("k") + F.col("v")).alias("most"))
    fixed = nodes.join(small(most), "host").filter(
        (F.col("k") >= VOTES) & (F.col("k") >= CONSTANT * (F.col("k") + F.col("v"))) & (F.col("k") >= PRESENT * F.col("most")))
    return fixed.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("template"))


def main_text(html: str, template=frozenset()) -> str:
    """Blocks of main text, joined by empty lines; '' if there is none.

    If parts of names leave no text at all, as where they mark the element around the
    whole page, only whole names count; if there is none then, forms are read as well, as
    some pages are one form.
    """
    root = parsed(html or "")
    holding = containers(root)
    return (_blocks(root, template, True, holding) or _blocks(root, template, False, holding)
            or _blocks(root, template, True, holding, True) or _blocks(root, template, False, holding, True)
            or _blocks(root, template, False, holding, True, False))


def _blocks(root, template, only_main, holding, whole=False, forms=True):
    out, words = [], []

    def end():
        text = " ".join("".join(words).split())
        if text:
            out.append(text)
        words.clear()

    # An explicit stack: pages may be nested deeper than Python may recurse.
    todo = [(root, 0, "/", False)]
    while todo:
        node, i, path, inside = todo.pop()
        if i == 0 and node.tag in BLOCK:
            end()
        if i >= len(node.children):
            if node.tag in BLOCK:
                end()
            continue
        todo.append((node, i + 1, path, inside))
        child = node.children[i]
        if isinstance(child, str):
            if inside or not only_main:
                words.append(child)
        elif child.tag == "br":
            words.append(" ")
        elif child.tag in VOID:
            if child.tag == "hr":
                end()
        else:
            deeper = inside or child.tag in MAIN
            # Folding passes over inline elements and what is nested very deeply, so paths do as well.
            below = f"{path}/{step_of(child)}" if child.tag in BLOCK and path.count("/") <= DEPTH else path
            fixed = below is not path and below in template and (child.label or not deeper)
            if not set_apart(child, deeper, holding, whole, forms) and not fixed:
                todo.append((child, 0, below, deeper))
            elif child.tag in BLOCK:
                end()
    end()
    return "\n\n".join(out)


def extracted(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``id_col, url, text`` of every page.

    NULL and empty pages give ''. A NULL or hostless URL makes pages of the host ''. NULL
    ids and repeated rows stay as they are; an empty table gives an empty one; extra
    columns are not read. Jobs run when called.
    """
    wrappers = stored(induced(pages, url, html)).withColumnRenamed("host", "w_host")
    rows = pages.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{url}`").alias("u"), F.col(f"`{html}`").alias("html"))
    ready = rows.withColumn("host", F.coalesce(host_of(F.col("u")), F.lit(""))).join(
        small(wrappers), F.col("host") == F.col("w_host"), "left").select("id", "u", "html", "template")

    def run(batches):
        for pdf in batches:
            text = [main_text(h, frozenset(t) if t is not None else frozenset()) for h, t in zip(pdf["html"], pdf["template"])]
            yield pd.DataFrame({"id": pdf["id"], "u": pdf["u"], "text": text})

    out = ready.mapInPandas(run, "id string, u string, text string")
    return out.withColumn("id", F.col("id").cast(pages.schema[id_col].dataType)).withColumnRenamed("id", id_col).withColumnRenamed("u", url)
