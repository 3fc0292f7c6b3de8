"""A small tolerant reader of HTML for the tasks of wrapper induction."""
import re
from html import unescape

# Fixed values of HTML: elements without content, with raw content, of block layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math object select".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
pre search section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
SCOPE = {"table", "td", "th", "caption", "button", "html", "body"}
# Start tag -> open elements it ends, up to one of the third column.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    """An element; ``children`` holds nodes and strings in page order."""
    __slots__ = ("tag", "label", "role", "children", "parent")

    def __init__(self, tag, label="", role="", parent=None):
        self.tag, self.label, self.role, self.children, self.parent = tag, label, role, [], parent


def parsed(html: str) -> Node:
    """The tree of a page. Elements left open end with their parent."""
    root = now = Node("")
    at, n = 0, len(html)
    lower = None
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            now.children.append(unescape(html[at:]))
            break
        if m.start() > at:
            now.children.append(unescape(html[at:m.start()]))
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            node = now
            while node.parent is not None and node.tag != tag:
                node = node.parent
            if node.parent is not None:
                now = node.parent
            continue
        if tag in CLOSES_P:
            now = _ended(now, {"p"}, SCOPE)
        if tag in ENDS:
            now = _ended(now, *ENDS[tag])
        attributes = m[3] or m[6] or ""
        label, role = "", ""
        if attributes:
            for key, a, b, c in NAMED.findall(attributes):
                key = key.lower()
                if key in ("class", "id"):
                    label += " " + (a or b or c)
                elif key == "role":
                    role = (a or b or c).lower()
                elif key == "hidden" or (a or b or c) == "true":
                    role = role or "hidden"
        node = Node(tag, label.strip(), role, now)
        now.children.append(node)
        if tag in RAW:
            if lower is None:
                lower = html.lower()
            end = lower.find("</" + tag, at)
            if end < 0:
                break
            close = html.find(">", end)
            at = n if close < 0 else close + 1
        elif tag not in VOID:
            now = node
    return root


def _ended(now, tags, stop):
    node = now
    while node.parent is not None and node.tag not in stop:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return now
